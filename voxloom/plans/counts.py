"""Counts of a plan's stages, taken while its one run passes the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageCounts:
    """Observations by stage; they have values once an action on the last frame is done.

    Counting adds no scan, shuffle or job: tasks count the rows they pass, and a few numbers a
    task reach the driver. Of attempts that are run again only one counts. An instance belongs
    to one run of one plan.
    """

    def __init__(self):
        self.stages: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str, **totals: Column) -> DataFrame:
        """The same rows; counts them, and sums up further columns, as a stage of this name."""
        if stage in self.stages:
            raise ValueError(f"stage {stage!r} is watched already")
        self.stages[stage] = Observation(stage)
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for name, c in totals.items()]
        return df.observe(self.stages[stage], F.count(F.lit(1)).alias("rows"), *sums)

    def values(self) -> dict[str, dict[str, int]]:
        """The counts by stage; waits for the action if it is still running."""
        return {stage: dict(seen.get) for stage, seen in self.stages.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """stage, metric, value: a row for each count."""
        rows = [(stage, metric, n) for stage, seen in self.values().items() for metric, n in seen.items()]
        return spark.createDataFrame(rows, "stage string, metric string, value bigint")


def unwatched(df: DataFrame, stage: str, **totals: Column) -> DataFrame:
    """In place of StageCounts.watch where nothing is counted."""
    return df
