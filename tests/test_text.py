"""Goldens for the text rules, sentences and utterances."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from voxloom.functions.text import ascii_digits, is_blank, strip, zero_padded
from voxloom.operators import normalize as nz
from voxloom.operators import sentences as st
from voxloom.plans.corpus import prepare_corpus

PARAGRAPHS = {
    0: "Chapter 1: The Start 1234 - First point is here.",
    1: "ve charge and positive charge * starred Numbered item launched a probe 14 is pi.",
    2: "text stays.",
    3: "mail me.org or now.",
    4: "see Next a- greater than b and c less than d!",
    5: "greater than start the gas is negativery cold (ok)",
    6: "tabs and wide spaces end?",
    9: 'Dr. Smith paid 3.50 dollars. Wait... what he said "stop." no terminator at the tail',
}
UTTERANCES_OF_TWO = [
    "Chapter 1: The Start 1234 - First point is here. ve charge and positive charge * starred "
    "Numbered item launched a probe 14 is pi.",
    "text stays. mail me.org or now.",
    "see Next a- greater than b and c less than d!\n\ngreater than start the gas is negativery "
    "cold (ok)\n\ntabs and wide spaces end?\n\nDr. Smith paid 3.50 dollars.",
    'Wait... what he said "stop." no terminator at the tail.',
]


@pytest.fixture(scope="module")
def f1(spark):
    return fx.frame(spark, fx.F1, fx.F1_SCHEMA)


def one_text(spark, *texts):
    return fx.frame(spark, list(enumerate(texts)), fx.F1_SCHEMA)


def test_clean_lines(f1):
    rows = nz.clean_lines(f1).collect()
    lines = [r.line for r in sorted(rows, key=lambda r: r.pos)]
    assert {r.doc_id for r in rows} == {900001}
    assert lines[:4] == ["Chapter 1: The Start", "1234", "-", "First point is here."]
    assert "tabs and wide spaces" in lines and len(lines) == 22


def test_paragraphs(f1):
    assert {r.para_no: r.para for r in nz.paragraphs(f1).collect()} == PARAGRAPHS


def test_normalised_text_is_the_kept_paragraphs(f1):
    texts = {r.doc_id: r.text for r in nz.normalize(f1).collect()}
    assert texts == {900001: "\n\n".join(PARAGRAPHS.values()), 900002: "", 900003: ""}


def test_stats(f1):
    stats = {r.doc_id: (r.raw_lines, r.paragraphs) for r in nz.normalize_stats(f1).collect()}
    assert stats == {900001: (28, 8), 900002: (4, 0), 900003: (1, 0)}


def test_utterances_of_two(f1):
    rows = st.utterances(nz.normalize(f1), 2).orderBy("utt_no").collect()
    assert [r.content for r in rows] == UTTERANCES_OF_TWO
    assert [r.utt_name for r in rows][0] == "sentence_0001.txt"


def test_utterance_count_is_ceiling(f1):
    text = nz.normalize(f1)
    for size in (1, 2, 3, 7, 100):
        made = st.utterances(text, size).groupBy("doc_id").count().collect()
        counts = {r.doc_id: r.utterances for r in st.utterance_counts(text, size).collect()}
        assert {r.doc_id: r["count"] for r in made} == {k: v for k, v in counts.items() if v}
        assert counts[900003] == 0


@pytest.mark.parametrize("size", [0, -1])
def test_group_size_must_be_positive(f1, size):
    with pytest.raises(ValueError):
        st.utterances(f1, size)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a. b.c 3.14. d", ["a", "b.c 3.14", "d"]),
        ("a.  . b", ["a", "b"]),
        (" . ", []),
        ("x  .\n\n y!", ["x", "y!"]),
        ("Wait... x", ["Wait..", "x"]),
        ("\u3000a .\u2003b", ["a", "b"]),
        ("one\n\ntwo.", ["one\n\ntwo"]),
    ],
)
def test_sentences(spark, text, expected):
    rows = st.sentences(one_text(spark, text)).orderBy("n").collect()
    assert [r.sentence for r in rows] == expected


def test_long_runs_of_one_character_stay_fast(spark):
    texts = [c * 200_000 + "x" for c in (" ", "\n", "\t", "-", "1", "@", "+ ", ".", "\u3000", "[", "<", "&")]
    rows = nz.normalize(one_text(spark, *texts))
    assert st.utterances(rows).count() >= 1


def test_names_grow_past_four_digits(spark):
    names = spark.range(1).select(
        st.utterance_name(F.lit(7), "p"), st.utterance_name(F.lit(12345), "p")
    )
    assert tuple(names.first()) == ("p_0007.txt", "p_12345.txt")


def test_character_classes(spark):
    row = spark.range(1).select(
        strip(F.lit("\x1c \u00a0a b\u3000\u0085")),
        is_blank(F.lit(" \u2028\x1f")),
        is_blank(F.lit("")),
        is_blank(F.lit("\u200b")),
        ascii_digits(F.lit("௧௨ 7 ٣")),
        zero_padded(F.lit(-1), 2),
    ).first()
    assert tuple(row) == ("a b", True, True, False, "12 7 3", "-1")


def test_prepare_corpus_does_not_shuffle_or_repeat_the_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = prepare_corpus(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert plan.count("https?") == 1
