"""Near-duplicate documents by SimHash and deletion-variant signatures.

Two fingerprints that differ in at most 3 bits are cut into two segments: one of them differs
in at most one bit. So each fingerprint is indexed under each segment with each one of its
bits left out (a variant), rows with an equal variant meet in a bucket, and their whole
fingerprints are compared. Equal fingerprints are one entry, so copies cost nothing.

A bucket of more than `limit` entries is not compared: its entries go one level deeper, where
the variant also holds half of the other segment with one bit left out, and then once more
with a quarter. Each step is exact by the same argument. The last level leaves 8 bits and 3
left-out bits open, so it holds at most 2048 different fingerprints. Buckets are streamed
from sorted partitions, and give the links of a spanning forest, not all pairs.

The similarity form (`similar_documents`) links pairs that share 0.8 of their five-word
shingles, in two steps. The first is the method above: SimHash over the different shingles,
deletion variants, fingerprints within 3 bits, and the exact similarity of each such pair. It
cannot be the only one, since pairs of similarity 0.8 differ in about 15 of 100 bits (the angle of
two such sets): a segment of 16 bits differs in at most one bit in 28 % of them only, and long
segments hardly ever, so one-wildcard variants would need hundreds of rows a document, in buckets
of 2^15 keys that grow with the square of the input. The second step adds the links that 3 bits
do not show, between what the first has not connected. Its candidates have an equal key among
BANDS keys, each the least values of ROWS hash functions over the different shingles. A pair of
similarity s shares a key with probability 1 - (1 - s^ROWS)^BANDS: all but 3 in a million at 0.8.
Keys are 64 bits, so unrelated documents do not meet. Equal shingle sets are one node. In each
bucket all pairs of fitting size are proposed, at growing distances in the bucket's order, and
verified by the exact similarity; pairs that are already connected are not proposed again, so a
large group of copies costs about one link for each. Documents of a bucket have a sketch, a byte of the least value of SKETCH further
functions: pairs whose sketches differ in clearly more bytes than the similarity allows are not
proposed. After the first round, in which neighbours of a bucket are proposed and verified by
joins, the rows that are left bring their shingles along: pairs are verified where they meet,
and only links leave the task, none between documents that it has connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import SLICE_BYTES, columns_from_text, free_name, frugal, one_row_of_each_id, settle, slices
from voxloom.llm.components import components, forest, spanning
from voxloom.llm.simhash import fingerprints, mixed, packed, shingle_hashes, signed, votes
from voxloom.operators.blocks import scope, small_side

BUCKET_LIMIT = 1024  # larger buckets go one level deeper
BANDS = 24
ROWS = 4  # hash functions of a band
RADIUS = 3  # bits in which fingerprints of the similarity form's first step differ, at most
SLICE = 512  # shingles hashed by all functions at once
SKETCH = 1024
DEVIATIONS = 4.5  # that a sketch may be off: 3 similar pairs in a million are lost
HELD = 1 << 13  # with their shingles, a bucket's rows are held back so far; pairs are joined beyond
REACH = 16  # distances in a bucket grow so many times in each round
LEVELS = (64, 32, 16)  # bits that are cut in two at each level


def hamming_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """key, f0 (bigint fingerprint), component, a row for each row of docs.

    Documents are linked if their 64-bit SimHash over shingles of so many words differs in at
    most radius (0 to 3) bits; component is the smallest key that can be reached, itself
    included. Null texts are empty; texts without words have fingerprint zero and are linked
    like any other. Rows that repeat a key give repeated rows and are one node. Rows with a
    null key get the component of their fingerprint, and null if no keyed row has it.
    Other columns are left out. An empty table gives an empty one.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two segments with one open bit find up to 3 differing bits")
    rows = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    rows = settle(fingerprints(rows, "_text", words).drop("_text"))
    groups = settle(rows.groupBy("f0").agg(F.min("_key").alias("node")))
    keyed = groups.filter(F.col("node").isNotNull())
    found = components(hamming_links(keyed, radius))
    named = settle(
        groups.join(found, "node", "left").select("f0", F.coalesce("component", "node").alias("component"))
    )
    # One key may have several fingerprints; the smallest component then stands for the key.
    return rows.join(named, "f0").select(F.col("_key").alias(key), "f0", "component")


def hamming_links(nodes: DataFrame, radius: int, pairs: bool = False) -> DataFrame:
    """Links a, b between nodes (node, f0; different f0) that connect all pairs in the radius.

    If pairs is set each link is itself a pair in the radius; else it may be a chain of them.
    """
    entries = nodes.select("node", "f0", F.lit(0).cast("bigint").alias("mask"))
    links = None
    for level, group in enumerate(LEVELS):
        wider = F.explode(_variants(F.col("mask"), group)).alias("mask")
        index = entries.select("node", "f0", wider)
        index = index.withColumn("key", F.xxhash64("mask", F.col("f0").bitwiseAND(F.col("mask"))))
        sorted_index = index.select("key", "node", "f0", "mask").repartition("key")
        sorted_index = sorted_index.sortWithinPartitions("key", "node")
        last = level == len(LEVELS) - 1
        scan = _exact_scan(radius, None if last else BUCKET_LIMIT, pairs)
        made = settle(sorted_index.mapInArrow(frugal(scan), "a bigint, b bigint, mask bigint, f0 bigint"))
        level_links = made.filter(F.col("mask").isNull()).select("a", "b")
        links = level_links if links is None else links.unionByName(level_links)
        entries = made.filter(F.col("mask").isNotNull()).select(
            F.col("a").alias("node"), "f0", "mask"
        )
        if last or entries.isEmpty():
            return links.distinct()
    return links.distinct()


def _variants(mask: Column, group: int) -> Column:
    """The mask with one half of an open group of bits added, one bit of the half left out."""
    half = group // 2
    choice = None
    for base in range(0, 64, group):
        added = [
            F.lit(signed((((1 << half) - 1) << low) & ~(1 << (low + bit))))
            for low in (base, base + half)
            for bit in range(half)
        ]
        grown = F.transform(F.array(*added), lambda x: mask.bitwiseOR(x))
        is_open = mask.bitwiseAND(F.lit(signed(((1 << group) - 1) << base))) == 0
        choice = F.when(is_open, grown) if choice is None else choice.when(is_open, grown)
    return choice


def near_pairs(key: np.ndarray, prints: np.ndarray, radius: int):
    """Positions i, an earlier j with the same key, and their distance, within the radius.

    key is sorted; rows of a key are compared at lag 1, 2, ... as long as any key is that long.
    """
    here, lag, found = np.arange(1, len(key)), 1, []
    while True:
        here = here[here >= lag]
        here = here[key[here] == key[here - lag]]
        if not len(here):
            break
        apart = np.bitwise_count(prints[here] ^ prints[here - lag]).sum(axis=1, dtype=np.int64)
        hit = apart <= radius
        found.append((here[hit], here[hit] - lag, apart[hit]))
        lag += 1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Buckets:
    """Cuts a sorted stream into whole buckets; one bucket at most is held.

    small(key, ids, prints, masks) gets complete buckets, large(ids, prints, masks, first)
    gets the rows of a bucket above the limit, piece by piece.
    """

    def __init__(self, limit, small, large):
        self.limit, self.small, self.large = limit, small, large
        self.held, self.key, self.over = None, None, False

    def feed(self, key, *columns):
        start = 0
        if self.key is not None:
            same = key == self.key
            start = len(key) if same.all() else int(np.argmin(same))
            if start:
                yield from self._extend([c[:start] for c in (key, *columns)])
            if start == len(key):
                return
        last = int(np.searchsorted(key[start:] == key[-1], True)) + start
        parts = [[c[start:last] for c in (key, *columns)]]
        if self.held is not None and not self.over:
            parts.insert(0, self.held)
        whole = [np.concatenate(c) for c in zip(*parts, strict=True)]
        if len(whole[0]):
            yield from self.small(*whole)
        self.held, self.key, self.over = None, key[-1], False
        yield from self._extend([c[last:] for c in (key, *columns)])

    def _extend(self, rows):
        if not self.over:
            if self.held is not None:
                rows = [np.concatenate(c) for c in zip(self.held, rows, strict=True)]
            self.held = rows
            if self.limit is None or len(rows[0]) <= self.limit:
                return
            self.over, self.held = True, None
            yield from self.large(*rows[1:], True)
        else:
            yield from self.large(*rows[1:], False)

    def end(self):
        if self.held is not None and not self.over:
            yield from self.small(*self.held)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _exact_scan(radius: int, limit: int | None, pairs: bool):
    names = ["a", "b", "mask", "f0"]

    def small(key, ids, prints, masks):
        i, j, _ = near_pairs(key, prints.view(np.uint64).reshape(-1, 1), radius)
        if pairs:
            some = spanning(len(key), i, j)
            moved, other = i[some], j[some]
        else:
            label = forest(len(key), i, j)
            moved = np.flatnonzero(label != np.arange(len(key)))
            other = label[moved]
        if len(moved):
            none = pa.nulls(len(moved), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[other]), none, none], names)

    def large(ids, prints, masks, first):
        none = pa.nulls(len(ids), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(ids), none, pa.array(masks), pa.array(prints)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets(limit, small, large)
        for batch in batches:
            if batch.num_rows:
                yield from buckets.feed(*_columns(batch, ["key", "node", "f0", "mask"]))
        yield from buckets.end()

    return run


# --- the similarity form -------------------------------------------------------------------


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The different shingle hashes, ascending."""
    made = list(shingle_hashes(text, words))
    return np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64)


def _odd(seed: int, size: int) -> np.ndarray:
    """Odd factors: multiplying by one, modulo 2**64, is a hash function of hashes."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 63, size, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


_BAND_FACTORS, _SKETCH_FACTORS = _odd(17, BANDS * ROWS), _odd(18, SKETCH)


def _least(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of each function over the shingles."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(shingles), SLICE):
        np.minimum(least, (shingles[s : s + SLICE, None] * factors).min(axis=0), out=least)
    return least


def sketch(shingles: np.ndarray) -> bytes:
    return (_least(shingles, _SKETCH_FACTORS) >> np.uint64(24)).astype(np.uint8).tobytes()


def sketch_distance(similarity: float) -> int:
    """Bytes in which the sketches of sets of that similarity differ, at most but for chance."""
    share = (1 - similarity) * 255 / 256
    return int(SKETCH * share + DEVIATIONS * (SKETCH * share * (1 - share)) ** 0.5)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key (bigint) for each band of a set of shingle hashes; an empty set has none."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in _least(shingles, _BAND_FACTORS).reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(0x9FB21C651E98DF25) + row, 1)
    return keys.view(np.int64)


def set_fingerprint(shingles: np.ndarray) -> int:
    """The SimHash of a set: every different shingle has one vote."""
    count = np.zeros(64, np.int64)
    for s in range(0, len(shingles), 1 << 16):
        count += votes(shingles[s : s + (1 << 16)])
    return packed(2 * count > len(shingles))


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """key, component for each different non-null key: near copies share a component.

    Documents are linked if the Jaccard similarity of their sets of word shingles is at least
    the given one, which must be 0.8 or more (the bands are made for it). Texts without words
    link with each other. Of rows that repeat a key that with the smallest hash of its text
    counts; equal hashes have equal texts.
    """
    if not 0.8 <= similarity <= 1:
        raise ValueError("the bands are made for similarities from 0.8 to 1")
    spark = docs.sparkSession
    with scope(spark) as kept:
        rows = docs.filter(F.col(key).isNotNull())
        rows = rows.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
        made = _signatures(rows.withColumn("_hash", F.xxhash64("_text")), words).drop("_text")
        best = settle(made).groupBy("_key").agg(
            F.min(F.struct("_hash", "same", "size", "bands", "f0")).alias("b"), F.count(F.lit(1)).alias("_rows")
        )
        own = settle(best.select("_key", "_rows", "b.*"))
        first = F.min(F.struct("_key", "_rows", "_hash", "size", "bands", "f0")).alias("n")
        nodes = settle(own.groupBy("same").agg(first).select("same", "n.*"))
        index = nodes.select(F.col("_key").alias("node"), "size", F.explode("bands").alias("key"))
        found = _linked(rows, nodes.select(F.col("_key").alias("node"), "_hash", "_rows", "f0"), index, words, similarity)
        named = nodes.select("same", F.col("_key").alias("component"))
        if found is not None:
            named = nodes.select("same", F.col("_key").alias("node")).join(found, "node", "left")
            named = named.select("same", F.coalesce("component", "node").alias("component"))
        return kept(own.join(named, "same").select(F.col("_key").alias(key), "component"))


def _signatures(rows: DataFrame, words: int) -> DataFrame:
    def make():
        def signatures(texts):
            sets = [shingle_set(t, words) for t in texts]
            return (
                [xxhash.xxh128_digest(s.tobytes()) for s in sets], [len(s) for s in sets],
                [band_keys(s) for s in sets], [set_fingerprint(s) for s in sets],
            )

        return signatures

    return columns_from_text(rows, "_text", "same binary, size int, bands array<bigint>, f0 bigint", make)


def _linked(
    rows: DataFrame, nodes: DataFrame, index: DataFrame, words: int, similarity: float
) -> DataFrame | None:
    """node, component of the nodes that are similar to another one; None if none can be.

    nodes has node, _hash, _rows and f0, index has node, size and key. What the fingerprints
    show is verified and connected first. Then a round proposes the pairs whose distance in a
    bucket of the index is within its reach; buckets end when they are shorter than that or all
    of their nodes are connected.
    """
    index = settle(_shared_keys(index, 1))
    close = settle(_print_links(nodes.select("node", "f0")))
    involved = index.select("node").unionByName(close.select(F.explode(F.array("a", "b")).alias("node")))
    involved = settle(involved.distinct())
    if involved.isEmpty():
        return None
    sets = _sets(rows, nodes.drop("f0").join(involved, "node"), words)
    with scope(rows.sparkSession) as kept:
        found = kept(components(settle(_verified(sets, close, similarity))))
    near = 1
    while True:
        far = 2 if near == 1 else near * REACH
        with scope(rows.sparkSession) as kept:
            own = index.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
            own = settle(_shared_keys(settle(own), near))
            if own.isEmpty():
                return found
            ordered = own.select("key", "size", "node", "component")
            here = near > 1 and far <= HELD  # verified where they meet
            ordered = ordered.join(sets if here else sets.select("node", "sketch"), "node")
            ordered = ordered.repartition("key").sortWithinPartitions("key", "size", "node")
            proposed = ordered.mapInArrow(frugal(_reach_scan(near, far, similarity)), "a bigint, b bigint").distinct()
            made = settle(proposed if here else _verified(sets, proposed, similarity))
            made = made.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
            found = kept(components(made))
            index = kept(own.drop("component"))
        near = far


def _print_links(nodes: DataFrame) -> DataFrame:
    """Pairs a, b of nodes (node, f0) whose fingerprints differ in RADIUS bits or fewer, enough
    to connect all such pairs: a chain through those with an equal one, and, between the smallest
    of each, those that meet by their deletion variants."""
    before = F.lag("node").over(Window.partitionBy("f0").orderBy("node"))
    chained = settle(nodes.withColumn("b", before))
    equal = chained.filter(F.col("b").isNotNull()).select(F.col("node").alias("a"), "b")
    return equal.unionByName(hamming_links(chained.filter(F.col("b").isNull()).select("node", "f0"), RADIUS, pairs=True))


def _shared_keys(index: DataFrame, above: int) -> DataFrame:
    """The rows of keys with more than so many rows, of more than one component if there are."""
    counts = [F.count(F.lit(1)).alias("n")]
    wanted = F.col("n") > above
    if "component" in index.columns:
        counts += [F.min("component").alias("low"), F.max("component").alias("high")]
        wanted &= F.col("low") != F.col("high")
    keys = index.groupBy("key").agg(*counts).filter(wanted).select("key")
    return index.join(keys, "key", "left_semi")


def _reach_scan(near: int, far: int, similarity: float):
    """Pairs of a bucket (rows sorted by key and size) that are near to far - 1 rows apart, of
    different components, of sizes and sketches that can be similar enough. Rows that bring
    their shingles are compared: only links come out, none twice between the same parts."""
    most = sketch_distance(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parent = None, {}

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = parent.get(up, up)
                c = up
            return c

        for batch in (part for whole in batches for part in slices(whole, SLICE_BYTES) if part.num_rows):
            rows = _columns(batch, ["key", "size", "node", "component"])
            names = batch.schema.names
            bodies = batch.column(names.index("sketch")).to_pylist()
            rows.append(np.frombuffer(b"".join(bodies), np.uint8).reshape(len(bodies), SKETCH))
            if "shingles" in names:
                sets = np.empty(len(bodies), object)
                sets[:] = [np.frombuffer(x, np.uint64) for x in batch.column(names.index("shingles")).to_pylist()]
                rows.append(sets)
            before = len(held[0]) if held else 0
            if held:
                rows = [np.concatenate(c) for c in zip(held, rows, strict=True)]
            key, size, node, component, sketches = rows[:5]
            here = np.arange(before, len(key))
            for lag in range(near, far):
                here = here[here >= lag]
                other = here - lag
                # Rows are sorted by size: what is too small at this distance is so at the next.
                fits = (key[other] == key[here]) & (size[other] / size[here] >= similarity)
                here, other = here[fits], other[fits]
                if not len(here):
                    break
                differ = np.flatnonzero(component[here] != component[other])
                chosen = [np.zeros(0, np.int64)]
                for s in range(0, len(differ), 4096):
                    some = differ[s : s + 4096]
                    some = some[(sketches[here[some]] != sketches[other[some]]).sum(axis=1) <= most]
                    if len(rows) > 5:
                        linked = []
                        for k in some.tolist():
                            a, b = root(int(component[here[k]])), root(int(component[other[k]]))
                            if a != b and jaccard(rows[5][here[k]], rows[5][other[k]]) >= similarity:
                                parent[max(a, b)] = min(a, b)
                                linked.append(k)
                        some = np.array(linked, np.int64)
                    chosen.append(some)
                pick = np.concatenate(chosen)
                if len(pick):
                    a, b = node[here[pick]], node[other[pick]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"]
                    )
            last = max(len(key) - far + 1, int(np.searchsorted(key, key[-1])), 0)
            held = [c[last:] for c in rows]

    return run


def _sets(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, shingles, sketch: the sorted sets of shingle hashes of these nodes (node, _hash, _rows).

    A key of several rows has one text of that hash, maybe more than once: it is reduced to one
    row first, which keys of one row need not.
    """

    def make():
        def both(texts):
            sets = [shingle_set(t, words) for t in texts]
            return [s.tobytes() for s in sets], [sketch(s) for s in sets]

        return both

    wanted, _ = small_side(settle(nodes))
    hashed = rows.withColumn("_hash", F.xxhash64("_text"))
    involved = hashed.join(wanted.withColumnRenamed("node", "_key"), ["_key", "_hash"])
    repeated = involved.filter("_rows > 1").groupBy("_key").agg(F.max("_text").alias("_text"))
    involved = involved.filter("_rows = 1").select("_key", "_text").unionByName(repeated)
    made = columns_from_text(involved, "_text", "shingles binary, sketch binary", make)
    return settle(made.select(F.col("_key").alias("node"), "shingles", "sketch"))


def _verified(sets: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """The links whose shingle sets are as similar as asked."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    pairs = links.join(first, "a").join(second, "b").select("a", "b", "one", "two")

    def run(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                keep = [
                    jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= similarity
                    for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                ]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(frugal(run), "a bigint, b bigint")


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    every = len(x) + len(y) - both
    return both / every if every else 1.0


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one document of each group of near copies, that with the smallest key.

    All columns stay. Rows without a key stay; of rows that repeat a key one stays, see
    one_row_of_each_id. Whole texts are shuffled only if more keys go than fit a broadcast.
    """
    member, spark = free_name(docs, "_component"), docs.sparkSession
    with scope(spark) as kept:
        whole = similar_documents(docs, key, text, **options)
        others = kept(whole.filter(F.col(key) != F.col("component")).select(F.col(key).alias(member)))
    few, _ = small_side(others)
    return one_row_of_each_id(docs.join(few, docs[key] == few[member], "left_anti"), key, text)
