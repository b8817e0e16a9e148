"""Ordered running totals over groups of any size.

A window partitioned by a group key runs each group in one task. That is the
right plan for ordinary groups and the wrong one for a group that holds a large
part of all rows. The functions here cut such a group into blocks of its order,
run the window inside each block, and add what the earlier blocks hold. Only one
small row per block goes through a window over the whole group.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A group with positions beyond this is handled in blocks of this many positions.
MAX_GROUP_ROWS = 1 << 20

# At most this many keys of long groups are broadcast; more are joined by shuffle.
MAX_BROADCAST_KEYS = 100_000

CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share for intermediate tables and stream progress.

    Taken from the session. Only a local session without one gets a folder of
    its own; a cluster must name it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="voxloom-")
        sc.setCheckpointDir(named)
    return named


# Paths of the tables that were settled in each open scope, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("voxloom_scopes", default=())


@contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Settled tables made inside are removed when the block ends, also by an error.

    What is yielded settles a table that outlives the block; it belongs to the scope around,
    if there is one. A frame that reads a removed table fails, so whatever leaves the block
    must be settled by it (or read no settled table).
    """
    outer = _SCOPES.get()
    own: list[str] = []
    token = _SCOPES.set((*outer, own))

    def kept(df: DataFrame) -> DataFrame:
        inner = _SCOPES.set(outer)
        try:
            return settle(df)
        finally:
            _SCOPES.reset(inner)

    try:
        yield kept
    finally:
        _SCOPES.reset(token)
        for path in own:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reads; an absent one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files at its end, not when the driver collects garbage."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)


def settle(df: DataFrame) -> DataFrame:
    """Write to the shared folder, so later uses read rows and do not recompute them.

    A columnar table, so that each use reads only the columns it needs. It stays until the
    scope around ends; without one, until the shared folder is cleaned. What was shuffled for it
    is removed at once: nothing reads it again.
    """
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid4()}"
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def long_groups(
    df: DataFrame, key: str, max_rows: int, position: str | None = None
) -> DataFrame:
    """Keys of groups with more than max_rows rows.

    With a 0-based position column this is a filter the scan can answer from file
    statistics. Without one, rows are counted, combined on the map side.
    """
    if position is not None:
        return df.filter(F.col(position) >= max_rows).select(key).distinct()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > max_rows).select(key)


def split_long_groups(
    df: DataFrame, key: str, max_rows: int, position: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of long groups (None if there are none).

    One small job finds the long keys. They are broadcast only after counting them.
    """
    keys, found = small_side(long_groups(df, key, max_rows, position))
    if found == 0:
        return df, None
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def small_side(keyed: DataFrame) -> tuple[DataFrame, int]:
    """One side of a join, marked for broadcast if it has few rows, and its row count
    (counted no further than matters). Otherwise Spark joins by shuffle."""
    found = keyed.limit(MAX_BROADCAST_KEYS + 1).count()
    return (F.broadcast(keyed) if found <= MAX_BROADCAST_KEYS else keyed), found


def position_block(position: str, block_rows: int) -> Column:
    """Block number of a 0-based integer position."""
    return F.call_function("div", F.col(position), F.lit(block_rows))


def range_blocks(df: DataFrame, order: list[str], name: str = "_block") -> DataFrame:
    """Contiguous, evenly filled blocks of any sort order, whatever its values.

    The block is the range partition, so the rows are settled: a second sampling
    could cut elsewhere.
    """
    ranged = df.repartitionByRange(*order).withColumn(name, F.spark_partition_id())
    return settle(ranged)


def running_totals(
    df: DataFrame, key: str, order: list[str], totals: dict[str, Column], block: str = "_block"
) -> DataFrame:
    """Add, per output name, the sum of a value over the earlier rows of the group.

    df has a block column and is used twice, so it should be settled or cheap.
    """
    values = {f"_v_{name}": value for name, value in totals.items()}
    df = df.withColumns({name: F.coalesce(value, F.lit(0)) for name, value in values.items()})

    per_block = df.groupBy(key, block).agg(*[F.sum(v).alias(v) for v in values])
    earlier_blocks = Window.partitionBy(key).orderBy(block).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_block.select(
        key, block, *[F.sum(v).over(earlier_blocks).alias(f"{v}_carry") for v in values]
    ).filter(F.col(f"{next(iter(values))}_carry").isNotNull())

    inside = Window.partitionBy(key, block).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    joined = df.join(carried, [key, block], "left")
    return joined.withColumns(
        {
            name: F.coalesce(F.col(f"_v_{name}_carry"), F.lit(0))
            + F.coalesce(F.sum(f"_v_{name}").over(inside), F.lit(0))
            for name in totals
        }
    ).drop(*values, *[f"{v}_carry" for v in values])
