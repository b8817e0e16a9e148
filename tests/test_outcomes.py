"""Outcome streams over several micro-batches, the merged track, and counted stages."""

from __future__ import annotations

from datetime import datetime, timedelta

from checks import fixtures as fx
from checks import inputs
from checks.queries import all_queries
from tests.test_groups import rows_of
from tests.test_streaming import stream_of
from voxloom.operators import manifest as mf
from voxloom.operators import normalize as nz
from voxloom.plans.batch import batch_report, files_report
from voxloom.plans.corpus import merged_track, prepare_corpus
from voxloom.plans.counts import StageCounts
from voxloom.streaming.outcomes import stream_outcomes
from voxloom.streaming.runs import run_available

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def test_outcomes_of_streams(spark, tmp_path):
    """Late, repeated and missing reports; each request comes out once, and files as in a batch."""
    asked = "file_no bigint, cue_no int, kind string, error string, requested_at timestamp"
    told = "file_no bigint, cue_no int, error string, reported_at timestamp"
    batches = [
        ([(1, 0, "prose", None, at(0)), (2, 1, "cue", None, at(1)), (2, 2, "cue", None, at(1)), (4, 0, "error", "blank", at(2))],
         [(2, 1, "no audio", at(5))]),
        ([(3, 0, "prose", None, at(200))], [(2, 1, None, at(20)), (1, 0, "failed", at(30)), (2, 2, "no audio", at(31))]),
        ([(5, 0, "prose", None, at(260))], [(3, 0, None, at(210)), (3, 0, "later", at(220))]),
        ([(9, 0, "end", None, at(9999))], [(5, 0, None, at(261 + 700)), (9, 0, None, at(9999))]),
        ([(9, 1, "end", None, at(20_000))], [(9, 1, None, at(20_000))]),
    ]
    sources = [str(tmp_path / "asked"), str(tmp_path / "told")]
    for rows in batches:
        for part, schema, source in zip(rows, (asked, told), sources, strict=True):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    streams = [
        stream_of(spark, spark.createDataFrame([], schema), source)
        for schema, source in zip((asked, told), sources, strict=True)
    ]
    made = stream_outcomes(*streams, wait="5 minutes", late="10 seconds")
    found = spark.read.schema(made.schema).parquet(run_available(made)).filter("kind <> 'end'")
    got = {(r.file_no, r.cue_no): r.error for r in found.collect()}
    assert found.count() == len(got) == 6
    none = "No outcome was reported."
    assert got == {(1, 0): "failed", (2, 1): None, (2, 2): "no audio", (3, 0): None, (4, 0): "blank", (5, 0): none}

    files = spark.createDataFrame([(n, f"{n}.txt") for n in range(1, 7)], "file_no bigint, path string")
    every = spark.read.schema(asked).parquet(sources[0]).filter("kind <> 'end'")
    in_time = spark.read.schema(told).parquet(sources[1]).filter("file_no < 5")
    whole = batch_report(files, every, in_time, "out")
    assert rows_of(files_report(files, found, "out")) == rows_of(whole) and whole.count() == 6


def test_state_of_outcomes_is_not_on_the_heap(spark, tmp_path):
    """A session with Spark's default store: requests and reports wait in RocksDB, its memory bounded."""
    plain = spark.newSession()
    store = "spark.sql.streaming.stateStore."
    plain.conf.set(f"{store}providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    plain.conf.set("spark.sql.shuffle.partitions", "2")
    tables = {
        "asked": ([(1, 0, "prose", None, at(0)), (2, 0, "prose", None, at(1)), (9, 0, "end", None, at(9999))],
                  "file_no bigint, cue_no int, kind string, error string, requested_at timestamp"),
        "told": ([(1, 0, None, at(5)), (9, 0, None, at(9999))], "file_no bigint, cue_no int, error string, reported_at timestamp"),
    }
    streams = []
    for name, (rows, schema) in tables.items():
        frame = plain.createDataFrame(rows, schema)
        frame.coalesce(1).write.parquet(str(tmp_path / name))
        streams.append(stream_of(plain, frame, str(tmp_path / name)))
    made = stream_outcomes(*streams)
    found = plain.read.schema(made.schema).parquet(run_available(made, str(tmp_path / "out")))
    assert {r.file_no: r.error for r in found.filter("file_no < 9").collect()} == {1: None, 2: "No outcome was reported."}
    state = [p.suffix for p in (tmp_path / "out" / "_progress" / "state").rglob("*")]
    assert ".zip" in state and ".delta" not in state
    assert plain.conf.get(f"{store}rocksdb.boundedMemoryUsage") == "true"


def test_merged_track(spark):
    requests = mf.synthesis_manifest(
        spark.createDataFrame([(1, n, f"s_{n:04d}.txt", "text") for n in (1, 2, 10, 11)],
                              "doc_id bigint, utt_no int, utt_name string, content string")
    )
    reported = spark.createDataFrame(
        [(f"1/s_{n:04d}", f"mp3/s_{n:04d}.mp3" if n != 2 else None, None, "failed" if n == 2 else None) for n in (1, 2, 10, 11)],
        "utt_id string, audio string, subtitle string, error string",
    )
    lengths = spark.createDataFrame([("mp3/s_0001.mp3", 1000), ("mp3/s_0010.mp3", 50)], "path string, duration_ms bigint")
    rows = merged_track(requests, reported, lengths).orderBy("position").collect()
    assert [(r.file_name, r.number, r.start_ms) for r in rows] == [("mp3/s_0001.mp3", 1, 0), ("mp3/s_0010.mp3", 10, 1500)]


def test_stage_counts_need_no_second_scan(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir).unionByName(fx.frame(spark, fx.F1, fx.F1_SCHEMA))
    counts = StageCounts()
    made = prepare_corpus(docs, 2, rate=5, generate_subtitles=True, counts=counts)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("CollectMetrics") == 4 and "Aggregate" not in plan
    rows = made.collect()
    assert {r.rate for r in rows} == {"+5%"} and rows[0].subtitle_name.endswith(".srt")
    stats = nz.normalize_stats(docs).selectExpr("sum(raw_lines) AS raw", "sum(paragraphs) AS kept").first()
    assert counts.values() == {
        "documents": {"rows": docs.count(), "raw_lines": stats.raw},
        "normalised": {"rows": docs.count(), "paragraphs": stats.kept},
        "utterances": {"rows": len(rows)},
        "requests": {"rows": len(rows), "failed": 0},
    }
    assert rows_of(counts.table(spark)) == sorted(
        ((s, m, n) for s, c in counts.values().items() for m, n in c.items()), key=lambda r: repr(tuple(r))
    ) or counts.table(spark).count() == 7


def test_texts_of_requests_are_read_once(spark, sf_dir):
    """Requests and reports of the outcome queries come from one settled table."""
    plan = all_queries()["batch_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "settled-" in plan


def test_summary_is_the_whole_message(spark):
    """Counts and each failure by number, in parts if there are many; a batch without files says so."""
    rows = [(1, n, f"out/u_{n}.txt", None if n in (1, 4) else f"error {n}") for n in (10, 7, 4, 3, 1)]
    rows += [(2, 1, "v_1.txt", None), (None, 5, "w_5.txt", "no audio")]
    outcomes = spark.createDataFrame(rows, "doc_id bigint, utt_no int, file string, error string")
    batches = spark.createDataFrame([(1,), (2,), (3,), (None,), (2,)], "doc_id bigint")
    found = mf.batch_summary(outcomes, batches=batches, requests_per_part=4).collect()
    got = {(r.doc_id, r.part_no): (r.successful, r.failed, r.total, r.summary) for r in found}
    head = "✅ Processed 2/5 files successfully.\n❌ 3 files failed.\n"
    assert len(found) == len(got) == 6 and got == {
        (1, 0): (2, 3, 5, head + "  - u_3.txt: error 3"),
        (1, 1): (2, 3, 5, "  - u_7.txt: error 7"),
        (1, 2): (2, 3, 5, "  - u_10.txt: error 10"),
        (2, 0): (1, 0, 1, "✅ Processed 1/1 files successfully."),
        (3, 0): (0, 0, 0, "No files provided."),
        (None, 1): (0, 1, 1, "✅ Processed 0/1 files successfully.\n❌ 1 files failed.\n  - w_5.txt: no audio"),
    }
    whole = {r.doc_id: r.summary for r in mf.batch_summary(outcomes).collect()}
    assert whole[1] == head + "\n".join(f"  - u_{n}.txt: error {n}" for n in (3, 7, 10))
