"""Document fingerprints: weighted SimHash, and search by permuted block tables.

Terms are pairs of neighbouring words (one-word texts: the word). Each term votes on 64 signed
bits with the weight 1 + ln(times it occurs), in sixteenths; a bit is 1 if its sum is positive.

Search: the 64 bits are cut into 6 blocks. Fingerprints within 3 bits agree in 3 blocks at
least, so each of the 20 choices of 3 blocks is a table keyed by those blocks. Queries meet
the index by equality in each table, and a pair is taken only from the first table in which
it agrees, so no pair comes twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import SLICE_BYTES, columns_from_text, settle, slices
from voxloom.llm.simhash import packed, shingle_hashes, signed

TERM_WORDS = 2
RADIUS = 3
BLOCKS = 6
FILTER_BITS = 1 << 26
BUCKET_BITS = 1 << 15  # of a row of the bitmap


def weighted_simhash(text: str | None) -> int:
    """The fingerprint as a signed integer; a text without words (or null) has zero."""
    parts = list(shingle_hashes(text, TERM_WORDS))
    if not parts:
        return 0
    terms, times = np.unique(np.concatenate(parts), return_counts=True)
    weights = np.floor(16 * (1 + np.log(times))).astype(np.int64)
    bits = np.unpackbits(terms.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Whole numbers below 2**53, so the floating-point product is exact.
    set_weight = weights.astype(np.float64) @ bits.astype(np.float64)
    return packed(2 * set_weight > weights.sum())


def with_fingerprint(df: DataFrame, text: str, name: str = "fingerprint") -> DataFrame:
    """Append the fingerprint (bigint) of each whole text."""

    def make():
        return lambda texts: [[weighted_simhash(t) for t in texts]]

    return columns_from_text(df, text, f"{name} bigint", make)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The kept bits of each table, one for each choice of blocks - radius blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [signed(sum(c)) for c in combinations(masks, blocks - radius)]


def find_within(
    index: DataFrame, queries: DataFrame, fingerprint: str = "fingerprint", radius: int = RADIUS
) -> DataFrame:
    """query, found, distance: every different fingerprint of the index in the radius of each.

    Both frames are reduced to different fingerprints first, so copies add no pairs. Null
    fingerprints match nothing. Up to BLOCKS - 1 bits. Before the tables are shuffled, index
    rows pass a bitmap of the queries' keys, of at most FILTER_BITS bits whatever their number.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"the radius must be below {BLOCKS}")
    masks = block_masks(radius)

    def table(df, name):
        distinct = df.select(F.col(fingerprint).alias(name)).filter(F.col(name).isNotNull()).distinct()
        keys = F.array(*[F.col(name).bitwiseAND(F.lit(m)) for m in masks])
        return distinct.select(name, F.posexplode(keys).alias("table", "key"))

    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, i) for i, m in enumerate(masks)])
    left, right = settle(table(queries, "query")), table(index, "found")
    joined = left.join(_asked_for(right, left), ["table", "key"]).filter(
        (F.bit_count(differ) <= radius) & (first == F.col("table"))
    )
    return joined.select("query", "found", F.bit_count(differ).alias("distance"))


def _asked_for(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """The rows whose table and key may be a query's: bits of their hashes, joined by bucket.

    The bitmap has FILTER_BITS / 32768 rows of 4 KB at most, so it is always broadcast.
    """
    place = F.pmod(F.xxhash64("table", "key"), F.lit(FILTER_BITS))
    placed = lambda df: df.withColumns(
        {"_bucket": F.shiftright(place, 15).cast("int"), "_bit": place.bitwiseAND(F.lit(BUCKET_BITS - 1)).cast("int")}
    )
    maps = placed(queries).groupBy("_bucket").agg(F.bitmap_construct_agg(F.col("_bit")).alias("_map"))
    byte = F.conv(F.hex(F.substring("_map", F.shiftright("_bit", 3) + 1, 1)), 16, 10).cast("int")
    is_set = F.expr("getbit(_byte, _bit % 8)") == 1
    found = placed(rows).join(F.broadcast(maps), "_bucket").withColumn("_byte", byte).filter(is_set)
    return found.select(*rows.columns)


# --- documents and their edited texts --------------------------------------------------------

_ROW = (
    "part int, kind int, id bigint, n bigint, fingerprint bigint, next_key bigint, next_fingerprint bigint,"
    " edited_sha256 string, edited_fingerprint bigint, text string"
)
_WHOLE, _FIRST, _LAST = 0, 1, 2


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of the next."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _edited(text: str, following: str) -> tuple[str, int]:
    made = edited_text(text, following)
    return hashlib.sha256(made.encode("utf-8", "surrogatepass")).hexdigest(), weighted_simhash(made)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order of id: each text meets the next. The first and the last text of
    the range come as rows of their own, for the ranges beside it."""
    part, held, first = TaskContext.get().partitionId(), None, True
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    types = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _ROW.split(", "))])

    def frame(rows):
        columns = zip(zip(*rows, strict=True), types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in columns], schema=types)

    for batch in batches:
        for piece in slices(batch, SLICE_BYTES):
            out = []
            for key, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                if held and held[0] == key:
                    continue  # sorted by the text's hash, so the one that counts came first
                now = (key, text, weighted_simhash(text))
                if first:
                    out.append((part, _FIRST, key, len(text), now[2], None, None, None, None, text))
                    first = False
                if held:
                    out.append((part, _WHOLE, held[0], len(held[1]), held[2], key, now[2], *_edited(held[1], text), None))
                held = now
            if out:
                yield frame(out)
    if held:
        yield frame([(part, _LAST, held[0], len(held[1]), held[2], None, None, None, None, held[1])])


def edited_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each different non-null key, with the fingerprint and that of an edited text.

    Columns: key, n_chars, next_key, fingerprint, next_fingerprint, edited_sha256,
    edited_fingerprint; the edited text is edited_text() of the text and of that of the next
    document in ascending order of the key; the first document follows the last. Null texts
    are empty. Of rows that repeat a key, that with the smallest hash of its text counts.
    Rows without a key are left out: they have no place in the order. A single document
    follows itself. Other columns are left out.

    Texts are shuffled once, into sorted ranges of the key. Inside a range each text meets the
    next as rows stream by; one text for each range crosses to the range before it.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    ranges = rows.filter(F.col("_id").isNotNull()).repartitionByRange("_id")
    ordered = ranges.sortWithinPartitions("_id", F.xxhash64("_text"))
    made = settle(ordered.mapInArrow(_neighbours, _ROW))
    order = Window.orderBy("part")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = made.filter(F.col("kind") == _FIRST)
    after = firsts.select(
        "part", F.coalesce(F.lead("part").over(order), F.first("part").over(every)).alias("_after")
    )
    beside = firsts.select(
        F.col("part").alias("_after"), F.col("id").alias("next_key"),
        F.col("fingerprint").alias("next_fingerprint"), F.col("text").alias("following"),
    )
    last = made.filter(F.col("kind") == _LAST).select("part", "id", "n", "fingerprint", "text")
    crossing = last.join(after, "part").join(beside, "_after").drop("_after", "part")
    result = ["id", "n", "next_key", "fingerprint", "next_fingerprint", "edited_sha256", "edited_fingerprint"]
    crossed = crossing.mapInArrow(_across, ", ".join(c for c in _ROW.split(", ") if c.split()[0] in result))
    whole = made.filter(F.col("kind") == _WHOLE).select(*result).unionByName(crossed.select(*result))
    return whole.select(F.col("id").alias(key), F.col("n").alias("n_chars"), *result[2:])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("text").to_pylist(), batch.column("following").to_pylist(), strict=True)
        made = [_edited(a, b) for a, b in pairs]
        names = ["id", "n", "fingerprint", "next_key", "next_fingerprint"]
        added = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())]
        arrays = [*[batch.column(n) for n in names], *added]
        yield pa.RecordBatch.from_arrays(arrays, [*names, "edited_sha256", "edited_fingerprint"])
