"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def builder(name: str) -> SparkSession.Builder:
    """A builder with settings that hold on any cluster size.

    Partition counts are left to adaptive execution: it joins small shuffle
    partitions and splits skewed ones. Stream state is kept in RocksDB, off the heap.
    """
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )


def local_session(name: str, cores: str | None = None) -> SparkSession:
    """A single-machine session for tests and measurements."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder(name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
