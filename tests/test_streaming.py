"""Streams equal the batch operators, over several micro-batches."""

import random
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from checks import fixtures as fx
from tests.test_groups import random_words, rows_of
from voxloom.operators import phrases as ph
from voxloom.operators.blocks import shared_dir
from voxloom.operators.normalize import normalize
from voxloom.operators.sentences import utterances
from voxloom.streaming import phrase_batches
from voxloom.streaming.phrase_batches import read_phrase_batches, write_phrase_batches
from voxloom.streaming import phrases as streamed
from voxloom.streaming.phrases import stream_phrases, word_runs
from voxloom.streaming.runs import run_available
from voxloom.streaming.utterances import stream_utterances


def write_batches(frame, path, batches, shuffled):
    """The rows as single files, read one per micro-batch."""
    rows = frame.collect()
    if shuffled:
        random.Random(9).shuffle(rows)
    size = -(-len(rows) // batches)
    for i in range(0, len(rows), size):
        part = frame.sparkSession.createDataFrame(rows[i : i + size], frame.schema)
        part.coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, frame, path):
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_phrases_in_any_order_of_arrival(spark, tmp_path):
    words = random_words(spark, 11, utterances=6)
    for shuffled in (False, True):
        source, out = str(tmp_path / f"in{shuffled}"), str(tmp_path / f"out{shuffled}")
        write_batches(words, source, 3, shuffled)
        made = stream_phrases(stream_of(spark, words, source))
        found = spark.read.schema(made.schema).parquet(run_available(made, out))
        assert rows_of(found) == rows_of(ph.phrases(words))


def test_words_go_to_the_state_in_runs(monkeypatch):
    """A row for each run of following words, whatever the words hold; nothing lost or reordered."""
    words = [("a", n, w) for n, w in enumerate(["", "வணக்கம்", "x y", "end."])] + [("a", 7, "b"), (None, 8, "c"), ("b", 0, "d"), ("b", 2, "e"), ("b", 1, "f")]
    rows = [(u, n, w, n * 10, n + 1, w == "end.") for u, n, w in words]
    schema = pa.schema([("utt_id", pa.string()), ("seq", pa.int64()), ("word", pa.string()), ("offset_ticks", pa.int64()),
                        ("duration_ticks", pa.int64()), ("is_last", pa.bool_())])
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def unpacked():
        runs = [r for b in word_runs(iter([batch.slice(0, 0), batch, batch.slice(2, 3)])) for r in b.to_pylist()]
        found = []
        for r in runs:
            ends = np.cumsum(np.frombuffer(r["lengths"], np.int32)).tolist()
            said = [r["text"][a:b] for a, b in zip([0, *ends], ends)]
            columns = [np.frombuffer(r[c], t).tolist() for c, t in (("offsets", np.int64), ("durations", np.int64), ("lasts", bool))]
            found += [(r["utt_id"], r["seq"] + i, *x) for i, x in enumerate(zip(said, *columns, strict=True))]
        return runs, found

    runs, found = unpacked()
    assert found == rows + rows[2:5] and len(runs) == 6 + 2
    monkeypatch.setattr(streamed, "RUN_BYTES", 1)
    assert unpacked()[1] == found


def test_phrases_with_the_default_state_store(spark, tmp_path):
    """A session that did not choose a state store: Spark's default keeps no list and map state."""
    plain = spark.newSession()
    name = "spark.sql.streaming.stateStore.providerClass"
    plain.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    words = random_words(plain, 13, utterances=3)
    source = str(tmp_path / "in")
    write_batches(words, source, 2, shuffled=True)
    made = stream_phrases(stream_of(plain, words, source))
    found = plain.read.schema(made.schema).parquet(run_available(made, str(tmp_path / "out")))
    assert rows_of(found) == rows_of(ph.phrases(words))


def test_phrase_batches_in_any_order_of_arrival(spark, tmp_path):
    words = random_words(spark, 12, utterances=6)
    for shuffled, block in ((False, 1000), (True, 16)):
        source, out = str(tmp_path / f"in{shuffled}"), str(tmp_path / f"out{shuffled}")
        write_batches(words, source, 3, shuffled)
        write_phrase_batches(stream_of(spark, words, source), out, block).awaitTermination()
        assert rows_of(read_phrase_batches(spark, out)) == rows_of(ph.phrases(words))


def test_phrase_batches_write_no_words_between(spark, tmp_path, monkeypatch):
    """Words go from the batch to phrases and state in one job; no table is made on the way."""

    def refuse(df):
        raise AssertionError("a table of words was written")

    monkeypatch.setattr(phrase_batches, "settle", refuse)
    words = random_words(spark, 14, utterances=4)
    source, out = str(tmp_path / "in"), tmp_path / "out"
    write_batches(words, source, 2, shuffled=True)
    write_phrase_batches(stream_of(spark, words, source), str(out), 16).awaitTermination()
    assert rows_of(read_phrase_batches(spark, str(out))) == rows_of(ph.phrases(words))


def test_phrase_batches_time_out_and_leave_no_tables(spark, tmp_path):
    """A word that never comes holds the rest only so long; state folders stay two."""
    words = fx.frame(spark, fx.F4, fx.F4_SCHEMA)
    source, out = str(tmp_path / "in"), tmp_path / "out"
    shared = Path(shared_dir(spark))
    before = {p.name for p in shared.iterdir() if p.name.startswith("settled")}
    words.filter("seq <> 3").coalesce(1).write.mode("append").parquet(source)
    other = words.withColumn("utt_id", F.lit("other"))
    stream = stream_of(spark, words, source)
    write_phrase_batches(stream, str(out), timeout_ms=1).awaitTermination()
    for seq in range(4):
        time.sleep(0.05)
        other.filter(F.col("seq") == seq).coalesce(1).write.mode("append").parquet(source)
        write_phrase_batches(stream, str(out), timeout_ms=60_000 if seq else 1).awaitTermination()
    found = read_phrase_batches(spark, str(out)).filter("utt_id = 'f4'")
    kept = words.filter("seq <> 3")
    assert sorted(r.text for r in found.collect()) == sorted(r.text for r in ph.phrases(kept).collect())
    assert len(list((out / "state").iterdir())) == 2
    assert {p.name for p in shared.iterdir() if p.name.startswith("settled")} == before


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    words = fx.frame(spark, fx.F4, fx.F4_SCHEMA)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for condition in ("seq < 4", "seq >= 4"):
        words.filter(condition).coalesce(1).write.mode("append").parquet(source)
        made = stream_phrases(stream_of(spark, words, source))
        rows = run_available(made, out)
    assert rows_of(spark.read.schema(made.schema).parquet(rows)) == rows_of(ph.phrases(words))


def test_abandoned_utterance_is_closed_after_the_timeout(spark, tmp_path):
    words = fx.frame(spark, fx.F4[:9], fx.F4_SCHEMA)
    source = str(tmp_path / "in")
    words.coalesce(1).write.parquet(source)
    made = stream_phrases(stream_of(spark, words, source), timeout_ms=100)
    query = made.writeStream.format("memory").queryName("abandoned").outputMode("append").start()
    try:
        for _ in range(60):
            rows = spark.table("abandoned").collect()
            if len(rows) == 4:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted(r.text for r in rows) == sorted(r.text for r in ph.phrases(words).collect())


def test_utterances(spark, tmp_path):
    docs = fx.frame(spark, fx.F1 + [(1, "One. Two\nthree.")], fx.F1_SCHEMA)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(docs, source, 2, False)
    made = stream_utterances(stream_of(spark, docs, source), 2)
    found = spark.read.schema(made.schema).parquet(run_available(made, out))
    assert rows_of(found) == rows_of(utterances(normalize(docs), 2))
