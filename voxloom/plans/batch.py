"""A batch of files: requests by content, and a report with one row for each file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.paths import base_name
from voxloom.functions.text import is_blank, strip
from voxloom.operators.manifest import BLANK_TEXT, NO_OUTCOME, VOICE
from voxloom.operators.subtitles import by_content, cue_blocks, cue_fields


def batch_requests(
    files: DataFrame,
    voice: str = VOICE,
    rate: int = 0,
    pitch: int = 0,
    volume: int = 0,
    key: str = "file_no",
    path: str = "path",
    text: str = "text",
    error: str = "error",
) -> DataFrame:
    """Requests of each file (key, path, text, error as the readers give them), row-locally.

    kind is "prose" (one request, cue_no 0), "cue" (one for each cue with text, timed) or
    "error" (no request: the file could not be read, or is blank). A subtitle file without
    a cue that has text makes no request.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    failed = F.coalesce(F.col(error), F.when(is_blank(content), F.lit(BLANK_TEXT)))

    def entry(kind, number, block):
        return F.struct(F.lit(kind).alias("kind"), number.cast("int").alias("cue_no"), block.alias("block"))

    # All three forms stand inside the generator, so a file is matched and parsed once.
    entries = (
        F.when(failed.isNotNull(), F.array(entry("error", F.lit(0), failed)))
        .when(by_content(content), F.transform(cue_blocks(content), lambda b, i: entry("cue", i + 1, b)))
        .otherwise(F.array(entry("prose", F.lit(0), content)))
    )
    rows = files.select(key, F.col(path).alias("path"), F.explode(entries).alias("e"))
    start, end, said = cue_fields(F.col("e.block"))
    is_cue = F.col("e.kind") == "cue"
    made = rows.select(
        key,
        "path",
        "e.kind",
        "e.cue_no",
        F.when(is_cue, start).alias("start_ms"),
        F.when(is_cue, end).alias("end_ms"),
        F.when(is_cue, said).when(F.col("e.kind") == "prose", strip(F.col("e.block"))).alias("text"),
        F.lit(voice).alias("voice"),
        F.lit(f"{rate:+d}%").alias("rate"),
        F.lit(f"{pitch:+d}Hz").alias("pitch"),
        F.lit(f"{volume:+d}%").alias("volume"),
        F.when(F.col("e.kind") == "error", F.col("e.block")).alias("error"),
    )
    return made.filter((F.col("kind") != "cue") | (F.col("text") != ""))


def outcomes_of(requests: DataFrame, reported: DataFrame, key: str = "file_no") -> DataFrame:
    """key, cue_no, kind, error (null for a success): a row for each request.

    reported has key, cue_no and error (null for a success); of repeated reports a success
    counts. The join is on (key, cue_no), so a file of very many cues spreads.
    """
    results = reported.groupBy(key, "cue_no").agg(F.min(F.coalesce("error", F.lit(""))).alias("_result"))
    joined = requests.select(key, "cue_no", "kind", "error").join(results, [key, "cue_no"], "left")
    said = F.when(F.col("_result").isNull(), F.lit(NO_OUTCOME)).otherwise(F.nullif("_result", F.lit("")))
    return joined.select(key, "cue_no", "kind", F.coalesce("error", said).alias("error"))


def files_report(
    files: DataFrame,
    outcomes: DataFrame,
    output_folder: str = "",
    generate_subtitles: bool = False,
    key: str = "file_no",
    path: str = "path",
) -> DataFrame:
    """A row for each file: requested and skipped cues, its audio and subtitle, or its error.

    outcomes is that of outcomes_of, or of the outcome stream. A prose file fails with its
    request. A cue that fails is skipped and its file succeeds, also without any cue. Of files
    only key and path are read; the key is unique. Outcomes are counted before the shuffle.
    """
    is_cue, failed = F.col("kind") == "cue", F.col("error").isNotNull()
    counted = outcomes.groupBy(key).agg(
        F.count_if(is_cue).alias("requested"),
        F.count_if(is_cue & failed).alias("skipped"),
        F.max(F.when(~is_cue, F.col("error"))).alias("error"),
    )
    rows = files.select(key, F.col(path).alias("path")).join(counted, key, "left")
    target = base_name(F.col("path"))
    target = F.concat(F.lit(f"{output_folder.rstrip('/')}/"), target) if output_folder else target
    done = F.col("error").isNull()
    subtitle = F.when(done, F.concat(target, F.lit(".srt"))) if generate_subtitles else F.lit(None).cast("string")
    return rows.select(
        key,
        "path",
        F.coalesce("requested", F.lit(0)).alias("requested"),
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
        F.when(done, F.concat(target, F.lit(".mp3"))).alias("audio"),
        subtitle.alias("subtitle"),
        "error",
    )


def batch_report(
    files: DataFrame,
    requests: DataFrame,
    reported: DataFrame,
    output_folder: str = "",
    generate_subtitles: bool = False,
    key: str = "file_no",
    path: str = "path",
) -> DataFrame:
    """files_report of what was reported for the requests."""
    return files_report(files, outcomes_of(requests, reported, key), output_folder, generate_subtitles, key, path)
