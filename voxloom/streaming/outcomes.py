"""Requests and their reports as streams -> one outcome for each request.

A left outer join of the two streams: a report belongs to its request if it comes within the
waiting time, in event time. When the watermark has passed that time, the request's outcome
comes out, once: what its reports say, or that none came. Repeated reports meet in an
aggregate by request; a success counts. Later reports are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.manifest import NO_OUTCOME
from voxloom.streaming.state import keep_state_on_disk

REQUESTED, REPORTED = "requested_at", "reported_at"


def stream_outcomes(
    requests: DataFrame, reports: DataFrame, wait: str = "10 minutes", late: str = "1 minute", key: str = "file_no"
) -> DataFrame:
    """key, cue_no, kind, requested_at, error (null for a success): a row for each request.

    requests has key, cue_no, kind, error (a request that cannot be made has one) and the
    timestamp requested_at; reports key, cue_no, error and reported_at. Rows that are more than
    `late` behind their stream may be lost. (key, cue_no, requested_at) names a request. State
    holds the requests and reports of the waiting time, on disk: in a session with Spark's default
    store, which is on the heap, this sets RocksDB. Both sides are partitioned by (key, cue_no), so
    a file of very many cues spreads. The batch form is plans.batch.outcomes_of.
    """
    keep_state_on_disk(requests.sparkSession)
    asked = requests.select(key, "cue_no", "kind", REQUESTED, F.col("error").alias("_own")).withWatermark(REQUESTED, late)
    told = reports.select(
        F.col(key).alias("_key"), F.col("cue_no").alias("_cue_no"), REPORTED, F.coalesce("error", F.lit("")).alias("_result")
    ).withWatermark(REPORTED, late)
    in_time = F.col(REPORTED).between(F.col(REQUESTED), F.col(REQUESTED) + F.expr(f"INTERVAL {wait}"))
    same = (F.col(key) == F.col("_key")) & (F.col("cue_no") == F.col("_cue_no")) & in_time
    joined = asked.join(told, same, "leftOuter")
    results = joined.groupBy(key, "cue_no", "kind", REQUESTED, "_own").agg(F.min("_result").alias("_best"))
    said = F.when(F.col("_best").isNull(), F.lit(NO_OUTCOME)).otherwise(F.nullif("_best", F.lit("")))
    return results.select(key, "cue_no", "kind", REQUESTED, F.coalesce("_own", said).alias("error"))
