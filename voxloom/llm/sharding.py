"""Sharding by histogram sort, with DataFrame operations only.

Rows get a random 64-bit key. The boundaries between shards are found without sorting: the
bytes below candidate boundaries are counted exactly over all partitions, and only the
intervals that hold a wanted boundary are probed further, until the bytes left in an interval
are below the tolerance. Rows are then exchanged once, by shard, and written.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import free_name, settle

SHARDS = 24
TOLERANCE = 0.001  # of a shard's bytes
PROBE_BITS = 10  # an interval is cut into 2**PROBE_BITS in each round
LAW = "bytes"
PART_BYTES = 64 << 20  # of texts that one task writes, about
MOST_PART_BITS = 16
SLOT_BITS = 12  # rows of a shard are numbered in so many ranges of the key


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """The smallest key of each shard after the first, as unsigned integers, ascending.

    rows has _key (bigint, its bits read as unsigned) and size. Each round counts, in all
    partitions, the bytes of every probe interval that can hold a boundary; one row for each
    of at most (shards - 1) * 2**PROBE_BITS intervals reaches the driver.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    wanted = [total * i / shards for i in range(1, shards)]
    allowed = max(tolerance * total / shards, 1)
    # Wanted boundary -> (prefix of the key, bytes below it); the prefix has `bits` bits.
    at, bits, done = {w: (0, 0) for w in wanted}, 0, {}
    while at and bits < 64:
        step = min(PROBE_BITS, 64 - bits)
        bits += step
        prefix = F.shiftrightunsigned("_key", 64 - bits)
        parents = sorted({p for p, _ in at.values()})
        near = rows.filter(F.shiftrightunsigned("_key", 64 - bits + step).isin(parents)) if bits > step else rows
        counts = {
            r["p"] % (1 << bits): r["n"]
            for r in near.groupBy(prefix.alias("p")).agg(F.sum("size").alias("n")).collect()
        }
        found = {}
        for w, (parent, below) in at.items():
            children = sorted(c for c in counts if c >> step == parent)
            for child, upto in zip(children, accumulate((counts[c] for c in children), initial=below), strict=False):
                if upto + counts[child] >= w:
                    break
            if counts[child] <= allowed or bits == 64:
                nearer = child if w - upto <= upto + counts[child] - w else child + 1
                done[w] = nearer << (64 - bits)
            else:
                found[w] = (child, upto)
        at = found
    return [done[w] for w in wanted]


def shard_of(key: Column, bounds: list[int]) -> Column:
    """How many boundaries are at or below the key; compared as signed, shifted by 2**63."""
    flipped = key.bitwiseXOR(F.lit(-(1 << 63)))
    shard = F.lit(0)
    for b in bounds:
        if b < 1 << 64:
            shard = shard + F.when(flipped >= F.lit(b - (1 << 63)), 1).otherwise(0)
    return shard


def random_key(key: str, text: str) -> Column:
    """A row's random key: a hash of what it holds and of its place among the rows, so even a
    table that repeats one row splits evenly."""
    return F.xxhash64(F.col(key), F.crc32(F.coalesce(F.col(text), F.lit(""))), F.monotonically_increasing_id())


def row_bytes(text: str) -> Column:
    """What a row counts for: the text's UTF-8 bytes (null: none) plus 8."""
    return (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 8).cast("bigint")


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Write docs as Parquet, a folder for each shard (shard=0, 1, ...); returns the shards read.

    All rows and columns are kept, and _order is added: a row's place in its shard, from 0, is
    that of (_order, file position) as `slots` numbers it. Shards hold nearly equal bytes
    (a text's UTF-8 bytes, null none, plus 8 for each row) and may be empty if there are fewer
    rows. Rows that repeat, and null keys and texts, are rows like any other. Input columns named
    shard or _order are replaced. An empty table writes none.

    Only narrow rows are read for the boundaries; then every row is exchanged once, by its shard
    and a range of keys that holds about PART_BYTES, so a large shard is written by many tasks.
    docs should be a scan or settled: the rows' places in it are part of their keys.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "_order")])
    random = free_name(rows, "_key")
    rows = rows.withColumn(random, random_key(key, text))
    narrow = settle(rows.select(F.col(random).alias("_key"), row_bytes(text).alias("size")))
    total = narrow.agg(F.sum("size")).first()[0] or 0
    bounds = splitters(narrow, shards, tolerance)
    placed = rows.withColumns(
        # Sorts as the unsigned key does.
        {"shard": shard_of(F.col(random), bounds), "_order": F.col(random).bitwiseXOR(F.lit(-(1 << 63)))}
    )
    bits = min(MOST_PART_BITS, (total // PART_BYTES).bit_length())
    part = F.shiftrightunsigned(random, 64 - bits) if bits else F.lit(0)
    dealt = placed.repartition(shards + (1 << bits), "shard", part)
    dealt = dealt.sortWithinPartitions("shard", "_order").drop(random)
    if not total:
        return dealt.limit(0)
    dealt.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(dealt.schema).parquet(path)


def slots(shards: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of written shards: key, size, text_crc32, shard, slot (bigint).

    Everything is derived from the shards; slots number a shard's rows without gaps from 0, in
    blocks of their order, and one row for each block goes through a window over the shard.
    """
    rows = settle(
        shards.select(
            F.col(key), row_bytes(text).alias("size"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
            "shard", "_order", F.shiftrightunsigned("_order", 64 - SLOT_BITS).alias("_block"),
        )
    )
    # Keys of 64 bits may meet; rows that are alike in all columns may stand in either order.
    inside = Window.partitionBy("shard", "_block").orderBy("_order", key, "text_crc32", "size")
    # A block is a range of the order, so blocks stand as their least rows do.
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_least"))
    chain = Window.partitionBy("shard").orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(chain), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_nth", F.row_number().over(inside)).join(before, ["shard", "_block"])
    return numbered.select(
        key, "size", "text_crc32", "shard", (F.col("_before") + F.col("_nth") - 1).cast("bigint").alias("slot")
    )
