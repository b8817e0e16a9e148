"""Work list -> synthesis requests -> outcome accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.paths import base_name, extension, file_name
from voxloom.functions.text import is_blank, strip

# Defaults and messages.
VOICE = "ta-IN-PallaviNeural"
BLANK_TEXT = "Please enter text to convert."
NO_OUTCOME = "No outcome was reported."
NO_FILES = "No files provided."

# A batch's summary message is cut into parts of this many requests.
REQUESTS_PER_PART = 10_000


def work_list(explicit: DataFrame, directory: DataFrame) -> DataFrame:
    """Explicit files and the directory's files, in that order, duplicates kept."""
    return explicit.select(F.lit(0).alias("origin"), "path").unionByName(
        directory.select(F.lit(1).alias("origin"), "path")
    )


def file_identity(paths: DataFrame, path: str = "path") -> DataFrame:
    """Base name and lower-cased extension of each path."""
    return paths.select(
        path,
        base_name(F.col(path)).alias("base_name"),
        F.lower(extension(F.col(path))).alias("extension"),
    )


def synthesis_manifest(
    utterances: DataFrame,
    voice: str = VOICE,
    rate: int = 0,
    pitch: int = 0,
    volume: int = 0,
    generate_subtitles: bool = False,
    key: str = "doc_id",
) -> DataFrame:
    """One request per utterance; blank text carries an error instead of a request."""
    base = base_name(F.col("utt_name"))
    subtitle = F.concat(base, F.lit(".srt")) if generate_subtitles else F.lit(None).cast("string")
    return utterances.select(
        key,
        "utt_no",
        F.concat_ws("/", F.col(key).cast("string"), base).alias("utt_id"),
        F.col("utt_name").alias("file"),
        strip(F.col("content")).alias("text"),
        F.lit(voice).alias("voice"),
        F.lit(f"{rate:+d}%").alias("rate"),
        F.lit(f"{pitch:+d}Hz").alias("pitch"),
        F.lit(f"{volume:+d}%").alias("volume"),
        F.concat(base, F.lit(".mp3")).alias("audio_name"),
        subtitle.alias("subtitle_name"),
        F.when(F.coalesce(is_blank(F.col("content")), F.lit(True)), F.lit(BLANK_TEXT)).alias("error"),
    )


def manifest_errors(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Requests that cannot be made."""
    return manifest.filter(F.col("error").isNotNull()).select(key, "utt_no", "file", "error")


def batch_outcomes(
    manifest: DataFrame, outcomes: DataFrame, key: str = "doc_id", attempt: str | None = None
) -> DataFrame:
    """Every request with its result: audio (and subtitle) or an error.

    A request that was reported more than once counts once: by its last attempt if a column
    numbers them, else by a success if there is one. So utt_id is unique on both sides, and
    the join spreads evenly.
    """
    order = F.col(attempt) if attempt else -F.coalesce(F.length("error"), F.lit(0))
    last = F.max_by(F.struct("audio", "subtitle", "error"), order)
    reported = outcomes.groupBy("utt_id").agg(last.alias("_r")).select(
        "utt_id", "_r.audio", "_r.subtitle", F.col("_r.error").alias("_error"), F.lit(True).alias("_found")
    )
    joined = manifest.select(key, "utt_no", "utt_id", "file", "error").join(
        reported, "utt_id", "left"
    )
    error = F.coalesce(
        "error", "_error", F.when(F.col("_found").isNull(), F.lit(NO_OUTCOME))
    )
    staged = joined.withColumn("error", error)

    def unless_failed(name: str) -> Column:
        return F.when(F.col("error").isNull(), F.col(name)).alias(name)

    return staged.select(
        key, "utt_no", "utt_id", "file", unless_failed("audio"), unless_failed("subtitle"), "error"
    )


def output_files(outcomes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Files written, audio before subtitle; (utt_no, place) is the order in a batch."""
    files = outcomes.select(
        key, "utt_no", F.posexplode(F.array("audio", "subtitle")).alias("place", "path")
    )
    return files.filter(F.col("path").isNotNull())


def _batch_counts(outcomes: DataFrame, key: str, *more: Column) -> DataFrame:
    """Successes, failures and total per batch; counted on the map side first."""
    return outcomes.groupBy(key).agg(
        F.count_if(F.col("error").isNull()).alias("successful"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        *more,
    )


def _head_lines() -> Column:
    """The message's first lines, from the counts of a batch; none of failures if there are none."""
    counts = F.format_string("✅ Processed %d/%d files successfully.", "successful", "total")
    failures = F.format_string("❌ %d files failed.", "failed")
    return F.array(counts, F.when(F.col("failed") > 0, failures))


def _failure_line() -> Column:
    return F.format_string("  - %s: %s", file_name(F.col("file")), F.col("error"))


def batch_summary(
    outcomes: DataFrame, key: str = "doc_id", batches: DataFrame | None = None, requests_per_part: int = REQUESTS_PER_PART
) -> DataFrame:
    """Successes, failures, total and the summary message per batch: a line with the counts, and
    if any failed one with their number and one for each, by utt_no.

    batches, if given, has the key of every batch; one without a request has zeros and says so.
    A batch of very many requests comes as parts of so many requests, those with failures in
    them (part_no; the first has the counts), so no group grows with the batch: joined by line
    feeds in their order they are the message. Each part has the counts of the whole batch.
    """
    failed = F.col("error").isNotNull()
    part = F.coalesce(F.call_function("div", F.col("utt_no") - 1, F.lit(requests_per_part)), F.lit(0)).cast("bigint")
    counts = _batch_counts(outcomes, key, F.min(F.when(failed, part)).alias("_first"))
    lines = F.sort_array(F.collect_list(F.struct("utt_no", _failure_line().alias("line"))))
    parts = outcomes.filter(failed).groupBy(F.col(key).alias("_key"), part.alias("part_no")).agg(lines.getField("line").alias("_lines"))
    if batches is not None:
        every = batches.select(F.col(key).alias("_batch")).distinct()
        counts = every.join(counts, F.col("_batch").eqNullSafe(F.col(key)), "left").select(
            F.col("_batch").alias(key), *[F.coalesce(n, F.lit(0)).alias(n) for n in ("successful", "failed", "total")], "_first"
        )
    rows = counts.join(parts, F.col(key).eqNullSafe(F.col("_key")), "left")
    head = F.when(F.col("total") == 0, F.array(F.lit(NO_FILES))).otherwise(_head_lines())
    head = F.when(F.col("part_no").isNull() | (F.col("part_no") == F.col("_first")), head).otherwise(F.array().cast("array<string>"))
    message = F.concat(head, F.coalesce("_lines", F.array().cast("array<string>")))
    return rows.select(
        key, F.coalesce("part_no", F.lit(0)).alias("part_no"), "successful", "failed", "total", F.array_join(message, "\n").alias("summary")
    )


def batch_summary_lines(outcomes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The summary message as rows, ordered by (section, utt_no).

    A batch may have any number of failures, so the message is never one value.
    """
    head = _batch_counts(outcomes, key).select(key, F.posexplode(_head_lines()).alias("section", "line"))
    head = head.filter(F.col("line").isNotNull())
    each = outcomes.filter(F.col("error").isNotNull()).select(
        key, F.lit(2).alias("section"), "utt_no", _failure_line().alias("line")
    )
    return head.select(key, "section", F.lit(0).alias("utt_no"), "line").unionByName(each)


def _marked_cues(placement: DataFrame, cue_outcomes: DataFrame, key: str) -> DataFrame:
    failed = cue_outcomes.filter(F.col("error").isNotNull()).select(key, "cue_no").distinct()
    failed = failed.withColumn("skipped", F.lit(True))
    return placement.join(failed, [key, "cue_no"], "left")


def placed_cues(placement: DataFrame, cue_outcomes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cues to lay into the track: those with text whose synthesis did not fail."""
    kept = _marked_cues(placement, cue_outcomes, key).filter(F.col("skipped").isNull())
    return kept.drop("skipped")


def cue_skip_report(
    files: DataFrame, placement: DataFrame, cue_outcomes: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Per subtitle file, requested, skipped and placed cues; the file itself succeeds.

    A file without a cue to place has zeros. Of files only the key is read.
    """
    counted = _marked_cues(placement, cue_outcomes, key).groupBy(key).agg(
        F.count(F.lit(1)).alias("requested"),
        F.count("skipped").alias("skipped"),
        F.count_if(F.col("skipped").isNull()).alias("placed"),
    )
    return files.select(key).join(counted, key, "left").fillna(0, ["requested", "skipped", "placed"])
