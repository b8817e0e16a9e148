"""Run a stream over all data that is there, then stop."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from voxloom.operators.blocks import shared_dir


def new_run(spark: SparkSession) -> str:
    """A new folder for one run, in the folder all executors share."""
    return f"{shared_dir(spark)}/stream-{uuid4()}"


def run_available(stream: DataFrame, path: str | None = None, mode: str = "append") -> str:
    """Write a stream's available input as Parquet; returns the folder.

    Rows and progress go to the shared folder, so a lost executor or a restart
    goes on from the last finished micro-batch.
    """
    path = path or new_run(stream.sparkSession)
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/_progress")
        .trigger(availableNow=True)
        .start(f"{path}/rows")
    )
    query.awaitTermination()
    return f"{path}/rows"
