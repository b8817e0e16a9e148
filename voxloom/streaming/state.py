"""Where streams keep their state."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
JOIN_FORMAT = "spark.sql.streaming.join.stateFormatVersion"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Spark's default store keeps every row of state on the heap, in two versions, and has no
    column families; RocksDB keeps it on disk, its memory bounded for all stores of an executor
    together, and a join's four tables in one store. A query takes what is set when it starts, one
    that goes on keeps what it began with. What the session chose is left."""
    if spark.conf.get(STATE_STORE).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKS_DB)
    if spark.conf.get(BOUNDED, None) is None:
        spark.conf.set(BOUNDED, "true")
    if spark.conf.get(STATE_STORE) == ROCKS_DB and spark.conf.get(JOIN_FORMAT, None) is None:
        spark.conf.set(JOIN_FORMAT, "3")
