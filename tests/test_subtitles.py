"""Goldens for subtitle parsing, time codes and rendering."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from voxloom.functions.timecode import ms_to_timecode, timecode_to_ms
from voxloom.operators import manifest as mf
from voxloom.operators import subtitles as sb


@pytest.fixture(scope="module")
def f2(spark):
    return fx.frame(spark, fx.F2, fx.F2_SCHEMA)


def test_detection(f2):
    flags = {r.doc_id - 900000: (r.by_name, r.by_content) for r in sb.srt_detect(f2).collect()}
    assert flags == {1: (True, True), 2: (False, True), 3: (True, False), 4: (True, True)}


def test_cues(f2):
    rows = sb.srt_cues(f2).orderBy("doc_id", "cue_no").collect()
    assert [(r.doc_id - 900000, r.start_ms, r.end_ms, r.text) for r in rows] == [
        (1, 1000, 2500, "Hello world"),
        (1, 3000, 4000, ""),
        (1, 3600005, 3601000, "5"),
        (4, 5000, 6000, "y"),
    ]


def test_flat_text_and_length(f2):
    texts = {r.doc_id - 900000: r.text for r in sb.srt_flat_text(f2).collect()}
    assert texts == {1: "Hello world  5", 2: "", 4: "y"}
    lengths = {r.doc_id - 900000: r.length_ms for r in sb.cue_track_length(f2).collect()}
    assert lengths == {1: 3602000, 2: 1000, 4: 7000}


def test_placement_leaves_out_empty_cues(f2):
    counts = sb.cue_placement(f2).groupBy("doc_id").count().collect()
    assert {r.doc_id - 900000: r["count"] for r in counts} == {1: 2, 4: 1}


def test_rendered_cues_parse_to_themselves(f2):
    rendered = sb.render_srt(f2).withColumnRenamed("srt", "content")
    again = sb.srt_cues(rendered).filter("text != ''").drop("cue_no")
    before = sb.srt_cues(f2).filter("text != ''").drop("cue_no")
    assert sorted(again.collect()) == sorted(before.collect())


def test_rendered_parts_joined_are_the_whole(spark):
    cues = spark.range(1, 24).select(
        F.lit("u").alias("utt_id"), F.col("id").alias("n"), (F.col("id") * 10).alias("start_ms"),
        (F.col("id") * 10 + 5).alias("end_ms"), F.concat(F.lit("t"), "id").alias("text"),
    )
    whole = sb.render_rows(cues, "utt_id", "n").collect()
    parts = sb.render_rows(cues, "utt_id", "n", cues_per_part=5).orderBy("part_no").collect()
    assert len(whole) == 1 and len(parts) == 5
    assert "".join(r.srt for r in parts) == whole[0].srt


@pytest.mark.parametrize("ms, code", fx.F3)
def test_timecode(spark, ms, code):
    made = spark.range(1).select(ms_to_timecode(F.lit(ms)), timecode_to_ms(F.lit(code))).first()
    assert tuple(made) == (code, int(ms))


def test_timecode_of_other_digits_and_no_code(spark):
    codes = ["01:02:03,004", "௦௧:௦௨:௦௩,௦௦௪", "soon"]
    frame = spark.createDataFrame([(c,) for c in codes], "c string")
    assert [r[0] for r in frame.select(timecode_to_ms(F.col("c"))).collect()] == [3723004, 3723004, None]


def test_many_blank_lines_and_a_long_block(spark):
    content = "\n" * 50_000 + "1\n00:00:01,000 --> 00:00:02,000\n" + "line\n" * 50_000
    files = spark.createDataFrame([(1, "a.srt", content)], fx.F2_SCHEMA)
    row = sb.srt_cues(files).first()
    assert (row.cue_no, len(row.text)) == (1, 50_000 * 5 - 1)


def test_every_subtitle_file_has_a_skip_row(spark):
    files = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    placement = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "doc_id bigint, cue_no int, text string")
    reported = spark.createDataFrame(
        [(1, 2, "lost"), (1, 2, "lost again"), (1, 1, None)], "doc_id bigint, cue_no int, error string"
    )
    rows = sorted(tuple(r) for r in mf.cue_skip_report(files, placement, reported).collect())
    assert rows == [(1, 2, 1, 1), (2, 0, 0, 0)]
    assert [r.cue_no for r in mf.placed_cues(placement, reported).collect()] == [1]
