"""Word events as a stream -> phrases, for utterances of any length.

Keyed state handles an utterance in one task. Here each micro-batch runs the batch
operators instead, which cut long utterances into blocks. What a batch leaves open is in
Parquet tables in the shared folder: words of open phrases, words before their turn, and
one progress row per utterance.

A batch is one job: its words are shuffled once, by utterance and block, and each word that ends
a phrase sees the others of the phrase beside it. So closed phrases, the words that are left and
the progress made are told apart in place and written together, a folder for each kind. Only
utterances of more than a block are looked at before; the batch is read again for that.

Folders are named by the batch number and replaced as a whole, so a repeated batch
writes the same rows again. The state before the previous one and all tables of a batch are
removed, so the folders of an endless stream do not pile up.

With a timeout, an utterance that got no word for so long is closed as it is, gaps and all. That
happens in the next micro-batch, whatever it brings; without new words there is none.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxloom.functions.timecode import ticks_to_ms
from voxloom.operators.blocks import MAX_GROUP_ROWS, position_block, remove, running_totals, scope, settle, small_side
from voxloom.operators.phrases import MAX_WORDS, ends_in_punctuation, growing_phrases, phrase_text

_WORDS = (
    "utt_id string, seq bigint, word string, offset_ticks bigint, duration_ticks bigint, "
    "is_last boolean, since_ms bigint"
)
_PROGRESS = "utt_id string, first_seq bigint, first_phrase bigint, done boolean"
PHRASES = "utt_id string, phrase_no bigint, start_ms double, end_ms double, text string"


# What a batch writes.
CLOSED, LEFT, MOVED = "phrases", "words", "progress"
_HELD = ("word", "offset_ticks", "duration_ticks", "since_ms")


def _read(spark: SparkSession, folder: str, kind: str, schema: str) -> DataFrame:
    """The rows of one kind; the folder of a batch may have none."""
    columns = [c.split()[0] for c in schema.split(", ")]
    rows = spark.read.schema(f"{schema}, batch int, kind string").parquet(folder)
    return rows.filter(F.col("kind") == kind).select(*columns)


def _state(spark: SparkSession, path: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Waiting words and progress after a batch; empty before the first one."""
    if batch_id < 0:
        # limit(0) tells the optimizer that they are empty: what only they need is not shuffled.
        return spark.createDataFrame([], _WORDS).limit(0), spark.createDataFrame([], _PROGRESS).limit(0)
    return (
        _read(spark, f"{path}/rows/batch={batch_id}", LEFT, _WORDS),
        spark.read.schema(_PROGRESS).parquet(f"{path}/state/{batch_id}/progress"),
    )


def _due(words: DataFrame, progress: DataFrame) -> DataFrame:
    """Words with seq counted from the first one that is in no closed phrase."""
    known, _ = small_side(progress.select("utt_id", "first_seq", "first_phrase"))
    joined = words.join(known, "utt_id", "left").fillna(0, ["first_seq", "first_phrase"])
    # An already emitted word may come again; it is not needed.
    return joined.withColumn("seq", F.col("seq") - F.col("first_seq")).filter("seq >= 0")


def _timed_out(due: DataFrame, block_rows: int, limit_ms: int | None) -> DataFrame:
    """The words of utterances whose latest word came before the limit count as the next ones,
    and the last of them as the utterance's last."""
    if limit_ms is None:
        return due
    idle = due.groupBy("utt_id").agg(F.max("since_ms").alias("_came"))
    idle, found = small_side(settle(idle.filter(F.col("_came") < limit_ms).drop("_came")))
    if not found:
        return due
    late = settle(due.join(idle, "utt_id", "left_semi").withColumn("_block", position_block("seq", block_rows)))
    late = settle(running_totals(late, "utt_id", ["seq"], {"_before": F.lit(1)}).drop("_block"))
    ends = late.groupBy("utt_id").agg(F.max("_before").alias("_end"))
    late = late.join(ends, "utt_id").withColumns({"seq": F.col("_before"), "is_last": F.col("_before") == F.col("_end")})
    return due.join(idle, "utt_id", "left_anti").unionByName(late.select(*due.columns))


def _made(due: DataFrame, block_rows: int) -> DataFrame:
    """Closed phrases, the words that are left, and where utterances have come to: a row each,
    with its kind and the columns of that kind."""
    ends = growing_phrases(due, *_HELD, block_words=block_rows)
    ended = F.col("is_last") | (F.col("place") == MAX_WORDS - 1) | F.coalesce(ends_in_punctuation(F.col("word")), F.lit(False))
    # An utterance without an id is never waited for.
    is_open = F.col("is_final") & ~ended & F.col("utt_id").isNotNull()
    ends = ends.withColumn("_open", is_open)
    is_early, is_open = F.col("is_early"), F.col("_open")

    def listed(condition: Column, rows: Column) -> Column:
        return F.when(condition, rows).otherwise(F.array().cast("array<struct<kind:string,nth:int>>"))

    def row(kind: str, nth: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (F.lit(None) if nth is None else nth).cast("int").alias("nth"))

    moved = ~is_early & F.col("is_final") & (~is_open | (F.col("phrase_no") > 0))
    kinds = F.concat(
        listed(~is_early & ~is_open, F.array(row(CLOSED))),
        listed(~is_early & is_open, F.transform(F.sequence(F.lit(0), F.col("place").cast("int")), lambda i: row(LEFT, i))),
        listed(is_early, F.array(row(LEFT))),
        listed(moved, F.array(row(MOVED))),
    )
    rows = ends.select("*", F.explode(kinds).alias("_row")).select("*", "_row.kind", "_row.nth")

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    held, seq, phrase = F.col("_held"), F.col("first_seq") + F.col("seq"), F.col("first_phrase") + F.col("phrase_no")
    one = F.get("_held", F.col("nth"))
    left = {c: F.when(F.col("nth").isNull(), F.col(c)).otherwise(one.getField(c)) for c in _HELD}
    end = F.col("offset_ticks") + F.col("duration_ticks")
    columns = {
        "phrase_no": of(CLOSED, phrase),
        "start_ms": of(CLOSED, ticks_to_ms(F.get("_held", F.lit(0)).getField("offset_ticks"))),
        "end_ms": of(CLOSED, ticks_to_ms(end)),
        "text": of(CLOSED, phrase_text(held.getField("word"))),
        "seq": of(LEFT, F.when(F.col("nth").isNull(), seq).otherwise(seq - F.col("place") + F.col("nth"))),
        **{c: of(LEFT, value) for c, value in left.items()},
        "is_last": of(LEFT, F.col("nth").isNull() & F.col("is_last")),
        "first_seq": of(MOVED, F.when(is_open, seq - F.col("place")).otherwise(seq + 1)),
        "first_phrase": of(MOVED, F.when(is_open, phrase).otherwise(phrase + 1)),
        "done": of(MOVED, ~is_open & F.col("is_last")),
    }
    return rows.select("kind", "utt_id", *[value.alias(name) for name, value in columns.items()])


def _run_batch(batch: DataFrame, batch_id: int, path: str, block_rows: int, timeout_ms: int | None) -> None:
    spark, now = batch.sparkSession, time.time_ns() // 1_000_000
    # The stream's own session: a task keeps a file open for each kind and need not sort by it.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", 3)
    with scope(spark):
        _write_batch(batch.withColumn("since_ms", F.lit(now)), batch_id, path, block_rows, timeout_ms and now - timeout_ms)
    remove(spark, f"{path}/state/{batch_id - 2}")
    for kind in (LEFT, MOVED):
        remove(spark, f"{path}/rows/batch={batch_id - 2}/kind={kind}")


def _write_batch(batch: DataFrame, batch_id: int, path: str, block_rows: int, limit_ms: int | None) -> None:
    spark, folder = batch.sparkSession, f"{path}/rows/batch={batch_id}"
    waiting, progress = _state(spark, path, batch_id - 1)
    words = batch.select(*waiting.columns).unionByName(waiting)
    due = _timed_out(_due(words, progress), block_rows, limit_ms)
    writer = _made(due, block_rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("kind").parquet(folder)

    # Every number below only grows, so the newest row of an utterance is the maximum.
    newest = progress.unionByName(_read(spark, folder, MOVED, _PROGRESS)).groupBy("utt_id").agg(
        F.max("first_seq").alias("first_seq"),
        F.max("first_phrase").alias("first_phrase"),
        F.max("done").alias("done"),
    )
    newest.filter(~F.col("done")).write.mode("overwrite").parquet(
        f"{path}/state/{batch_id}/progress"
    )


def write_phrase_batches(
    words: DataFrame, path: str, block_rows: int = MAX_GROUP_ROWS, timeout_ms: int | None = None, **trigger: object
) -> StreamingQuery:
    """Start writing phrases to ``path/rows``; read them with ``read_phrase_batches``.

    words holds (utt_id, seq, word, offset_ticks, duration_ticks, is_last), each word
    once, in any order of arrival. trigger is that of a stream writer.
    """
    rows = words.select(
        "utt_id",
        F.col("seq").cast("bigint").alias("seq"),
        "word",
        F.col("offset_ticks").cast("bigint").alias("offset_ticks"),
        F.col("duration_ticks").cast("bigint").alias("duration_ticks"),
        F.coalesce("is_last", F.lit(False)).alias("is_last"),
    )
    return (
        rows.writeStream.foreachBatch(
            lambda batch, batch_id: _run_batch(batch, batch_id, path, block_rows, timeout_ms)
        )
        .option("checkpointLocation", f"{path}/_progress")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_phrase_batches(spark: SparkSession, path: str) -> DataFrame:
    """Phrases of all finished batches."""
    return _read(spark, f"{path}/rows", CLOSED, PHRASES)
