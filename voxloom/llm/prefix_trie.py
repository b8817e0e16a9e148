"""The trie of conversations' beginnings, as double-array tries of prefix shards.

Every conversation is a sequence of turns; each different beginning is a node. Equal sequences
are one, with their number and smallest id. Sequences are put in lexicographic order by a range
exchange, so a shard holds a contiguous part of the order however many of them begin alike, and
is cut into blocks of bounded size. In a block, turns get dense ids, BASE and CHECK arrays are
packed (a child's slot is its parent's BASE plus the turn's id, and CHECK names the parent), all
sequences are traversed through them, and numbers are summed up from the leaves to the root.

In a sorted order, only beginnings of a block's first and last sequence can also occur in
other blocks. All other nodes are complete. Those shared upper nodes come as one or two paths
of a block, with what hangs below them, and are merged globally: members are summed by the
beginning's digest; then each node belongs to the first path it is on, sums run up each path
over the nodes that belong to it, and are added up by node.

A conversation is one row here (24 bytes a turn after hashing), as a document is one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import settle

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_TURNS = 1 << 17  # a block ends after the sequence that reaches so many turns
TRIES = 64  # slots tried for a node with several children before the arrays are extended
NO_ENDS = hashlib.sha256(b"").hexdigest()

TURNS = "array<struct<a:bigint,b:bigint,w:bigint>>"
NODE = (
    "path bigint, depth bigint, key binary, parent_key binary, conv bigint, parent_conv bigint, words bigint,"
    " n bigint, children bigint, leaves bigint, saved bigint, digest string"
)
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]


def turn_lists(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, turns: a row for each non-null conversation id, its turns in order.

    Ordered by turn number (null first), then by role and text; null roles and texts are
    empty. A turn is two 64-bit hashes of its role and text, and the words of the text.
    Rows that repeat are turns of their own. Rows without an id belong to no conversation.
    """
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.struct(
            F.col(turn).alias("t"), F.coalesce(role, F.lit("")).alias("r"), F.coalesce(text, F.lit("")).alias("x")
        ).alias("one"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    return listed.select("conv_id", F.transform("all", _hashed).alias("turns"))


def _hashed(one: Column) -> Column:
    return F.struct(
        F.xxhash64(F.lit(1), one["r"], one["x"]).alias("a"),
        F.xxhash64(F.lit(2), one["x"], one["r"]).alias("b"),
        F.regexp_count(one["x"], F.lit(WORD)).cast("bigint").alias("w"),
    )


def with_heads_of(lists: DataFrame, every: int, most: int, taken: Column) -> DataFrame:
    """Each list with its first turns replaced by those of the conversation id - id % every.

    So many turns as taken says (at most `most`) go, and as many come, or all there are. A
    window runs over the ids of one head: at most 2 * every rows.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    head = F.max(F.when(F.col("conv_id") == F.col("_base"), F.slice("turns", 1, most)))
    rows = lists.withColumn("_base", base)
    rows = rows.withColumn("_head", head.over(Window.partitionBy("_base"))).withColumn("_h", taken)
    first = F.slice(F.coalesce("_head", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.lit(0), F.size("turns") - F.col("_h")))
    return rows.select("conv_id", F.concat(first, rest).alias("turns"))


# --- equal sequences -----------------------------------------------------------------------


def _distinct(lists: DataFrame) -> DataFrame:
    """turns, first (smallest id), n, digest of all ids: a row for each different sequence.

    The digest runs over ids in ascending order, so it is sequential for each sequence: ids
    are joined into pieces where a range exchange puts them, and only pieces go to the task
    that hashes them, streaming.
    """
    named = settle(
        lists.select(
            "conv_id", "turns", F.xxhash64(F.lit(3), "turns").alias("s1"), F.xxhash64(F.lit(4), "turns").alias("s2")
        )
    )
    ids = named.select("s1", "s2", "conv_id")
    ordered = ids.repartitionByRange("s1", "s2", "conv_id").sortWithinPartitions("s1", "s2", "conv_id")
    pieces = ordered.mapInArrow(_join_ids, "s1 bigint, s2 bigint, first bigint, n bigint, piece string")
    grouped = pieces.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "first")
    digests = grouped.mapInArrow(_digest_ids, "conv_id bigint, n bigint, digest string")
    return settle(named.select("conv_id", "turns").join(digests, "conv_id"))


def _runs(s1: np.ndarray, s2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of stretches of equal pairs."""
    new = np.flatnonzero((s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])) + 1
    return np.concatenate([[0], new]), np.concatenate([new, [len(s1)]])


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            s1, s2, ids = (batch.column(i).to_numpy() for i in range(3))
            begins, ends = _runs(s1, s2)
            listed = list(map(str, ids.tolist()))
            joined = [",".join(listed[b:e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            arrays = [pa.array(x) for x in (s1[begins], s2[begins], ids[begins], ends - begins, joined)]
            yield pa.RecordBatch.from_arrays(arrays, ["s1", "s2", "first", "n", "piece"])


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state, now = None, None

    def done(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2].hexdigest() for r in rows], pa.string())],
            ["conv_id", "n", "digest"],
        )

    for batch in batches:
        out = []
        for s1, s2, first, n, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now == (s1, s2):
                state[1] += n
                state[2].update(b"," + piece.encode())
                continue
            if state:
                out.append(state)
            now, state = (s1, s2), [first, n, hashlib.sha256(piece.encode())]
        if out:
            yield done(out)
    if state:
        yield done([state])


# --- one block -----------------------------------------------------------------------------


class DoubleArray:
    """BASE and CHECK over dense turn ids from 1; state 0 is the root, an unused CHECK is -1."""

    def __init__(self):
        self.base, self.check = [0], [-2]
        self.free = 1  # no slot below it is free

    def put(self, state: int, codes: list[int]) -> None:
        """Give the state children with these ids, ascending: the first base that fits.

        After TRIES places the children go behind all others, so packing stays linear.
        """
        check, first = self.check, codes[0]
        while self.free < len(check) and check[self.free] != -1:
            self.free += 1
        slot, tries = self.free, 0
        while slot < len(check):
            base = slot - first
            if check[slot] == -1 and all(base + c >= len(check) or check[base + c] == -1 for c in codes):
                break
            slot, tries = slot + 1, tries + 1
            if tries == TRIES:
                slot = len(check)
        base = slot - first
        missing = base + codes[-1] + 1 - len(check)
        if missing > 0:
            self.base += [0] * missing
            check += [-1] * missing
        self.base[state] = base
        for c in codes:
            check[base + c] = state

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.base, np.int64), np.array(self.check, np.int64)


@dataclass
class Block:
    """Different sequences in ascending order: turns one after the other, and their lengths."""

    a: np.ndarray
    b: np.ndarray
    w: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    n: np.ndarray
    digest: list[str]


def dense_ids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the different pairs, in their order."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), np.int64)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    ids = np.empty(len(a), np.int64)
    ids[order] = np.cumsum(new)
    return ids


def pack(codes: np.ndarray, lengths: np.ndarray) -> DoubleArray:
    """The double array of sorted sequences, built level by level."""
    trie = DoubleArray()
    starts = np.cumsum(lengths) - lengths
    rows, state, depth = np.flatnonzero(lengths > 0), np.zeros(len(lengths), np.int64), 0
    while len(rows):
        code, here = codes[starts[rows] + depth], state[rows]
        # Sorted sequences: equal states are neighbours, with ascending codes.
        new = np.ones(len(rows), bool)
        new[1:] = (here[1:] != here[:-1]) | (code[1:] != code[:-1])
        owners, children = here[new], code[new]
        cuts = np.flatnonzero(owners[1:] != owners[:-1]) + 1
        begins, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(owners)]
        listed, names = children.tolist(), owners.tolist()
        for x, y in zip(begins, ends, strict=True):
            trie.put(names[x], listed[x:y])
        state[rows] = np.fromiter((trie.base[s] for s in here.tolist()), np.int64, len(rows)) + code
        depth += 1
        rows = rows[lengths[rows] > depth]
    return trie


def block_nodes(block: Block, number: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a block (NODE). path is null for complete ones, else names one of two
    paths of shared ones: 2 * number for the first sequence's, 2 * number + 1 for the last's."""
    lengths = block.lengths
    codes = dense_ids(block.a, block.b)
    base, check = pack(codes, lengths).arrays()
    starts = np.cumsum(lengths) - lengths
    size = len(check)
    members, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    words, depth_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ends, shared = np.full(size, -1), np.zeros(size, bool)
    state, rows, depth, levels = np.zeros(len(lengths), np.int64), np.arange(len(lengths)), 0, []
    legs: list[list[int]] = [[], []]
    while True:
        here = state[rows]
        np.add.at(members, here, block.n[rows])
        np.minimum.at(conv, here, block.first[rows])
        levels.append(np.unique(here))
        depth_of[here] = depth
        if depth:
            words[here] = block.w[starts[rows] + depth - 1]
        over = lengths[rows] == depth
        ends[here[over]] = rows[over]
        for leg, edge in enumerate((0, len(lengths) - 1)):
            if lengths[edge] >= depth and not (leg and len(lengths) == 1):
                legs[leg].append(int(state[edge]))
        rows = rows[~over]
        if not len(rows):
            break
        child = base[state[rows]] + codes[starts[rows] + depth]
        if (check[child] != state[rows]).any():
            raise AssertionError("a sequence is not in its own trie")
        state[rows] = child
        depth += 1
    for leg in legs:
        shared[leg] = True
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    for level in reversed(levels[1:]):
        own = level[~shared[level]]  # what is shared adds nothing to its parent yet
        leaves[own] += children[own] == 0
        saved[own] += (members[own] - 1) * words[own]
        for total, value in ((children, 1), (leaves, leaves[own]), (saved, saved[own])):
            np.add.at(total, check[own], value)

    complete = np.concatenate([level[~shared[level]] for level in levels])
    keys = {}
    for leg, edge in enumerate((0, len(lengths) - 1)):
        running = xxhash.xxh3_128()
        for depth, slot in enumerate(legs[leg]):
            if depth:
                at = starts[edge] + depth - 1
                running.update(np.array([block.a[at], block.b[at]]).tobytes())
            keys[slot] = running.digest()
    for s in range(0, len(complete), 50_000):
        own = complete[s : s + 50_000]
        above = check[own]
        yield _node_batch(
            [None] * len(own), own, depth_of, [None] * len(own),
            [keys[p] if shared[p] else None for p in above.tolist()], conv,
            [None if shared[p] else int(conv[p]) for p in above.tolist()],
            words, members, children, leaves, saved, [block.digest[e] if e >= 0 else None for e in ends[own].tolist()],
        )
    told: set[int] = set()
    for leg, path in enumerate(legs):
        own = np.array(path, np.int64)
        if not len(own):
            continue
        # The stem that both paths share is counted with the first.
        fresh = np.array([p not in told for p in path])
        told.update(path)
        zeroed = [np.where(fresh, x[own], 0) for x in (members, children, leaves, saved)]
        totals = [np.zeros(size, np.int64) for _ in zeroed]
        for total, value in zip(totals, zeroed, strict=True):
            total[own] = value
        yield _node_batch(
            [2 * number + leg] * len(own), own, depth_of, [keys[p] for p in path],
            [None, *[keys[p] for p in path[:-1]]], conv, [None] * len(own),
            words, *totals, [block.digest[e] if e >= 0 else None for e in ends[own].tolist()],
        )


def _node_batch(path, own, depth, key, parent_key, conv, parent_conv, words, n, children, leaves, saved, digest):
    numbers = [x[own] for x in (depth, conv, words, n, children, leaves, saved)]
    depth, conv, words, n, children, leaves, saved = (pa.array(x, pa.int64()) for x in numbers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(path, pa.int64()), depth, pa.array(key, pa.binary()), pa.array(parent_key, pa.binary()), conv,
            pa.array(parent_conv, pa.int64()), words, n, children, leaves, saved, pa.array(digest, pa.string()),
        ],
        NODE_NAMES,
    )


def _scan(block_turns: int):
    def blocks(batches):
        held, turns = [], 0
        for batch in batches:
            lists = batch.column(0)
            lengths = np.diff(lists.offsets.to_numpy())
            cuts, at = [], 0
            for i, size in enumerate(lengths.tolist()):
                turns += size + 1
                if turns >= block_turns:
                    cuts.append((at, i + 1))
                    at, turns = i + 1, 0
            for x, y in cuts:
                held.append(batch.slice(x, y - x))
                yield held
                held = []
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for nth, held in enumerate(blocks(batches)):
            table = pa.Table.from_batches(held).combine_chunks()
            lists = pa.concat_arrays(table.column(0).chunks)
            flat = lists.flatten()
            a, b, w = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            block = Block(
                a, b, w, np.diff(lists.offsets.to_numpy()).astype(np.int64),
                table.column(1).to_numpy(), table.column(2).to_numpy(), table.column(3).to_pylist(),
            )
            yield from block_nodes(block, (task << 30) + nth)

    return run


# --- all nodes -----------------------------------------------------------------------------


def trie_nodes(lists: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """A row for each different beginning of the lists (conv_id, turns), from the empty root.

    Columns (bigint): conv_id (smallest member), depth, parent_conv_id (the parent's conv_id;
    root: null), n_convs, n_children, n_leaves (childless nodes at or below it), saved_tokens
    (over its subtree, (n_convs - 1) * words of the last turn), and ends_sha256: of the ids
    whose whole list this is, ascending, joined by commas. A conversation without turns is a
    member of the root only. No conversations: no node, not even the root.
    """
    ordered = _distinct(lists).select("turns", "conv_id", "n", "digest")
    ordered = ordered.repartitionByRange("turns").sortWithinPartitions("turns")
    nodes = settle(ordered.mapInArrow(_scan(block_turns), NODE))
    upper = _merged(nodes.filter(F.col("path").isNotNull()))
    names = upper.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv"))
    whole = nodes.filter(F.col("path").isNull())
    columns = ["depth", "conv", "parent_conv", "n", "children", "leaves", "saved", "digest"]
    below = whole.filter(F.col("parent_key").isNotNull()).drop("parent_conv").join(names, "parent_key")
    inner = whole.filter(F.col("parent_key").isNull()).select(*columns)
    shared = upper.join(names, "parent_key", "left").select(*columns)
    return inner.unionByName(below.select(*columns)).unionByName(shared).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _merged(paths: DataFrame) -> DataFrame:
    """The shared nodes, one row each, from the paths of all blocks."""
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    whole = paths.groupBy("key").agg(
        *sums, F.min("conv").alias("conv"), F.min("path").alias("owner"),
        F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.max("parent_key").alias("parent_key"), F.max("digest").alias("digest"),
    )
    whole = settle(whole)
    more = whole.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key"))
    whole = whole.join(more.agg(F.count(F.lit(1)).alias("more")), "key", "left")
    whole = whole.withColumn("children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more")
    whole = settle(
        whole.withColumns(
            {
                "leaves": F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0),
                "saved": F.col("saved") + (F.col("n") - 1) * F.col("words"),
            }
        )
    )
    mine = F.col("owner") == F.col("path")
    values = whole.select("key", "owner", *[F.col(c).alias(f"own_{c}") for c in ("leaves", "saved")])
    upward = Window.partitionBy("path").orderBy(F.desc("depth"))
    placed = paths.select("path", "depth", "key").join(values, "key")
    carried = [F.sum(F.when(mine, F.col(f"own_{c}")).otherwise(0)).over(upward).alias(c) for c in ("leaves", "saved")]
    totals = placed.select("key", *carried).groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return settle(whole.drop("leaves", "saved", "owner").join(totals, "key"))
