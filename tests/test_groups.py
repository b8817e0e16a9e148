"""Phrases, pages, tracks: goldens, and long groups equal to ordinary ones."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import inputs
from voxloom.operators import manifest as mf
from voxloom.operators import pages as pg
from voxloom.operators import phrases as ph
from voxloom.operators import timeline as tl
from voxloom.operators.blocks import shared_dir, split_long_groups
from voxloom.plans.corpus import prepare_corpus, prepare_corpus_from_chunks


def rows_of(df):
    return sorted(df.collect(), key=repr)


def random_words(spark, seed, utterances=12):
    rng = random.Random(seed)
    rows = []
    for u in range(utterances):
        offset, n = 0, rng.choice([1, 2, 5, 6, 40, 150])
        for seq in range(n):
            word = rng.choice(["a", "be", "see", ",", ".", "end.", "so,", ".5", "ha!", "", "x y", "t "])
            duration = rng.randrange(0, 3000) * 1000 + rng.randrange(10)
            rows.append((f"u{u}", seq, word, offset, duration, seq == n - 1))
            offset += duration + rng.choice([0, 1000, 2_999_999, 3_000_000, 3_000_001, 5_000_000])
    return fx.frame(spark, rows, fx.F4_SCHEMA)


def test_phrases_golden(spark):
    rows = ph.phrases(fx.frame(spark, fx.F4, fx.F4_SCHEMA)).orderBy("phrase_no").collect()
    assert [(r.start_ms, r.end_ms, r.text) for r in rows] == [
        (0, 250, "Hello,"),
        (300, 800, "one two three four five"),
        (1100, 1200, "six"),
        (1501, 2001, "seven eight"),
    ]


@pytest.mark.parametrize("seed, block", [(1, 7), (2, 3), (3, 32)])
def test_long_utterances_give_the_same_phrases(spark, seed, block):
    words = random_words(spark, seed)
    assert rows_of(ph.phrases(words, block)) == rows_of(ph.phrases(words))
    assert rows_of(ph.phrase_breaks(words, block)) == rows_of(ph.phrase_breaks(words))


def test_words_are_not_shuffled_to_find_longer_utterances(spark):
    """Blocks of the usual size: keys of longer utterances are broadcast to all words."""
    words = random_words(spark, 4)
    for made in (ph.phrase_breaks(words), ph.phrases(words)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "LeftSemi" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_one_utterance_of_three_million_words(spark):
    """Five words, then two up to a comma, over and over; a pause before each ninth word of a
    hundred thousand. Cut into 46 blocks, with no job before the action."""
    n = 3_000_000
    words = spark.range(n).select(
        F.lit("u").alias("utt_id"), F.col("id").alias("seq"),
        F.when(F.col("id") % 7 == 6, "x,").otherwise("x").alias("word"),
        (F.col("id") * 4_000_000 + F.floor(F.col("id") / 100_000) * 10_000_000).alias("offset_ticks"),
        F.lit(4_000_000).cast("bigint").alias("duration_ticks"), (F.col("id") == n - 1).alias("is_last"),
    )
    spark.sparkContext.setJobGroup("lazy", "phrases")
    made = ph.phrases(words)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    ends = np.array([i % 7 == 6 or i % 100_000 == 99_999 or i == n - 1 for i in range(n)])
    expected, begin = [], 0
    for end in np.flatnonzero(ends).tolist():
        expected += range(begin, end + 1, 5)
        begin = end + 1
    starts = np.array(expected)
    offsets = starts * 400 + starts // 100_000 * 1000
    rows = made.select("phrase_no", "start_ms").toPandas().sort_values("phrase_no")
    assert rows["phrase_no"].tolist() == list(range(len(expected)))
    assert (rows["start_ms"].to_numpy() == offsets).all()


def test_words_of_phrases_are_the_words(spark):
    words = random_words(spark, 4).filter("word rlike '^[a-z]+$'")
    kept = ph.phrases(words).agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert kept == words.count()


def test_only_long_groups_are_split_off(spark):
    words = random_words(spark, 5)
    ordinary, none = split_long_groups(words, "utt_id", 1000, "seq")
    assert none is None and ordinary is words
    ordinary, long = split_long_groups(words, "utt_id", 5, "seq")
    counted, long_counted = split_long_groups(words, "utt_id", 5)
    assert rows_of(long) == rows_of(long_counted) and rows_of(ordinary) == rows_of(counted)
    assert ordinary.count() + long.count() == words.count() and long.count() > 0


@pytest.mark.parametrize("size, max_pages", [(1, 1), (2, 2), (3, 3)])
def test_long_documents_give_the_same_utterances(spark, sf_dir, size, max_pages):
    pages = inputs.pages(spark, sf_dir)
    noise = fx.frame(
        spark,
        [
            (800001, i, text)
            for i, text in enumerate(
                ["Open line", None, "goes on. Here\n12", "\r\nstill open", "closed!", ". dot first.",
                 "no end (yes)\nshort.\nCopyright me", "", "tail of it", "12", "last one ."]
            )
        ],
        "doc_id bigint, page_no bigint, text string",
    )
    both = pages.unionByName(noise)
    assert rows_of(pg.utterances_from_pages(both, size, max_pages=max_pages)) == rows_of(
        pg.utterances_from_pages(both, size)
    )


def test_assembled_parts_joined_are_the_text(spark, sf_dir):
    pages = inputs.pages(spark, sf_dir)

    def joined(**options):
        texts = {}
        parts = pg.assemble_pages(pages, **options).orderBy("doc_id", "part_no").collect()
        for r in parts:
            texts[r.doc_id] = texts.get(r.doc_id, "") + r.text
        return texts, len(parts)

    whole, parts = joined()
    assert parts == len(whole) + 1  # one document has more pages than a part
    halves, more = joined(pages_per_part=2)
    assert halves == whole and more > parts


@pytest.mark.parametrize("size", [1, 3, 50])
def test_pages_of_chunks_are_the_text(spark, size):
    texts = {1: "a\nbb\n\nccc", 2: "no feed at all", 3: "", 4: "\n\n", 5: "x\r\ny\rz\n", 6: "tail\n" * 40}
    rows = [(d, n, t[s : s + size]) for d, t in texts.items() for n, s in enumerate(range(0, max(1, len(t)), size))]
    chunks = spark.createDataFrame([*rows, (6, 10_000, None)], "doc_id bigint, chunk_no int, text string")
    pages = {}
    for r in pg.pages_of_chunks(chunks, block_rows=7).orderBy("doc_id", "page_no").collect():
        pages.setdefault(r.doc_id, []).append((r.page_no, r.text))
    for d, t in texts.items():
        assert [n for n, _ in pages[d]] == list(range(len(pages[d])))
        assert "\n".join(x for _, x in pages[d]) == t or "\n".join(x for _, x in pages[d]) + "\n" == t


def test_chunks_leave_two_tables_and_no_join_of_texts(spark, monkeypatch):
    """Long texts are told by their pages, not by joins; tables and shuffle files in between go."""

    def refuse(*_):
        raise AssertionError("texts were joined")

    monkeypatch.setattr(pg, "split_long_groups", refuse)
    texts = {1: "One line. And more\n" * 30, 2: "Short text. Of two sentences", 3: "Many lines here.\n" * 200, None: "No number\n" * 9}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = [(d, n, t[s : s + 11]) for d, t in texts.items() for n, s in enumerate(range(0, len(t), 11))]
    chunks = spark.createDataFrame(rows, "doc_id bigint, chunk_no int, text string")
    monkeypatch.setattr(pg.pages_of_chunks, "__defaults__", ("doc_id", "chunk_no", "text", 64, None))
    flags = {r.doc_id: r.is_long for r in pg.pages_of_chunks(chunks, max_pages=16).groupBy("doc_id").agg(F.every("is_long").alias("is_long")).collect()}
    assert flags == {1: True, 2: False, 3: True, None: False}
    shared = Path(shared_dir(spark))
    before = set(shared.glob("settled-*"))
    made = prepare_corpus_from_chunks(chunks, max_pages=16, sentences_per_utterance=2)
    assert len(set(shared.glob("settled-*")) - before) == 2
    assert rows_of(made) == rows_of(prepare_corpus(docs, 2))


def test_timeline_golden(spark):
    rows = tl.track_timeline(fx.frame(spark, fx.F6, fx.F6_SCHEMA)).collect()
    found = {r.file_name: (r.number, r.position, r.start_ms) for r in rows}
    assert found == {
        "sentence_0001.mp3": (1, 1, 0),
        "sentence_0002.mp3": (2, 2, 1500),
        "merged.mp3": (3, 3, 3500),
        "sentence_0010.mp3": (10, 4, 13000),
        "intro": (None, 5, 14200),
        "t_0012.mp3": (12, 1, 0),
        "t_௧௨.mp3": (12, 2, 508),
        "b_99999999999999999999999.mp3": (None, 3, 1015),
        "a_100000000000000000000000.mp3": (None, 4, 1520),
    }
    lengths = {r.album_id: r.total_ms for r in tl.album_length(fx.frame(spark, fx.F6, fx.F6_SCHEMA)).collect()}
    assert lengths == {900001: 14210, 900002: 1526}


def test_timeline_of_null_albums_and_numbers(spark):
    """A null album is one; 40 digits are kept; nothing runs before the action."""
    rows = [(None, f"{i}.mp3", 10) for i in range(30)] + [(1, "9" * 40, 5), (1, "intro", 6)]
    tracks = spark.createDataFrame(rows, fx.F6_SCHEMA)
    spark.sparkContext.setJobGroup("timeline", "lazy")
    made = tl.track_timeline(tracks)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("timeline")
    found = {(r.album_id, r.file_name): (r.digits, r.number, r.position, r.start_ms) for r in made.collect()}
    assert found[1, "9" * 40] == ("9" * 40, None, 1, 0) and found[1, "intro"] == (None, None, 2, 505)
    assert [found[None, f"{i}.mp3"][2:] for i in range(30)] == [(i + 1, 510 * i) for i in range(30)]


def test_long_albums_give_the_same_timeline(spark, monkeypatch):
    rng = random.Random(6)
    names = [f"{rng.choice('abcxyz')}{i}_{rng.choice(['', '7', '12', '003'])}.mp3" for i in range(300)]
    plain = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(200)]
    rows = [(rng.choice([1, 1, 1, 2]), name, rng.randrange(5000)) for name in names + plain]
    rows += [(3, "only.mp3", 5)]
    tracks = spark.createDataFrame(rows, fx.F6_SCHEMA)
    whole = rows_of(tl.track_timeline(tracks))
    for digits, chars in ((0, 0), (1, 1), (0, 30)):
        monkeypatch.setattr(tl, "BLOCK_DIGITS", digits)
        monkeypatch.setattr(tl, "NAME_CHARS", chars)
        assert rows_of(tl.track_timeline(tracks)) == whole


def test_outcomes_golden(spark):
    manifest = spark.createDataFrame(
        [(1, n, str(n), file, None) for n, file, *_ in fx.F5_FILES] + [(1, 4, "4", "u_0004.txt", None)],
        "doc_id bigint, utt_no int, utt_id string, file string, error string",
    )
    reported = spark.createDataFrame(
        [(str(n), audio, subtitle, error) for n, _, audio, subtitle, error in fx.F5_FILES],
        "utt_id string, audio string, subtitle string, error string",
    )
    outcomes = mf.batch_outcomes(manifest, reported)
    summary = mf.batch_summary(outcomes).first()
    assert (summary.successful, summary.failed, summary.total) == (2, 2, 4)
    lines = mf.batch_summary_lines(outcomes).orderBy("section", "utt_no").collect()
    assert [r.line for r in lines] == [
        "✅ Processed 2/4 files successfully.",
        "❌ 2 files failed.",
        "  - u_0002.txt: Please enter text to convert.",
        "  - u_0004.txt: No outcome was reported.",
    ]
    files = mf.output_files(outcomes).orderBy("utt_no", "place").collect()
    assert [r.path for r in files] == ["mp3/u_0001.mp3", "mp3/u_0001.srt", "mp3/u_0003.mp3"]
