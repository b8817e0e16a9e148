"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
from pathlib import Path
from unicodedata import normalize

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxloom.llm import common, decontaminate, fingerprint, language, mixing, near_dedup, sharding, token_files, tokens, toxicity, warc
from voxloom.llm.components import components
from voxloom.llm.simhash import simhash

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LONG = "wort " * 60_000
BASE = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, None, None, None),
    (4, "", "en", "b"), (5, LONG, "de", "b"), (None, BASE, "en", None), (7, "one", None, "a"),
    (8, "12 34 !!", "fr", "c"), (9, BASE.replace("word60", "other"), "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASH = ("score", "f0", "_key", "n_tokens", "_matches", "taken", "size", "_component", "n_chars")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({c: F.lit(7) for c in CLASH}).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.mark.parametrize("task_links", [7, 1 << 20])
def test_components_of_chains_and_stars(spark, task_links):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 30)] + [(5, 5), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a bigint, b bigint"), task_links=task_links).collect()))
    assert got == {i: 100 for i in range(101, 161)} | {i: 5 for i in range(6, 30)}


def test_hamming_components(docs, none):
    got = [(r[0], r["component"]) for r in near_dedup.hamming_components(docs).collect()]
    assert sorted((k for k, _ in got), key=str) == sorted((k for k, *_ in ROWS), key=str)
    by = dict(got)
    assert (by[1], by[2], by[None], by[4], by[3]) == (1, 1, 1, 3, 3)
    assert near_dedup.hamming_components(none).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 1024])
def test_deeper_levels_lose_no_link(spark, monkeypatch, limit):
    """A dense cluster, so that buckets overflow at small limits; against all pairs."""
    rng = np.random.default_rng(5)
    base = int(rng.integers(1 << 62))
    prints = sorted({base ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 7), replace=False)) for _ in range(150)})
    prints += [int(x) for x in rng.integers(1 << 62, size=50)]
    monkeypatch.setattr(near_dedup, "BUCKET_LIMIT", limit)
    nodes = spark.createDataFrame(list(enumerate(prints)), "node bigint, f0 bigint")
    got = dict(map(tuple, components(near_dedup.hamming_links(nodes, 3)).collect()))
    label = list(range(len(prints)))
    for _ in label:
        for i, p in enumerate(prints):
            label[i] = min(label[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3)
    assert [got.get(i, i) for i in range(len(prints))] == label


def test_similar_documents(docs, none):
    got = dict(map(tuple, near_dedup.similar_documents(docs).collect()))
    assert (got[1], got[2], got[9], got[3], got[4], got[5]) == (1, 1, 1, 3, 3, 5)
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in kept.collect()), key=str) == sorted([1, 3, 5, None, 7, 8], key=str)
    assert near_dedup.keep_one_of_each(none).count() == 0


def test_one_row_of_each_id(spark):
    rows = [(1, "b", 1), (1, "a", 2), (1, "a", 2), (None, "a", 3), (None, "a", 3), (2, None, 4), (2, "x", 5)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, _id bigint")
    got = [tuple(r) for r in common.one_row_of_each_id(table, "doc_id", "text").collect()]
    assert sorted(r[0] for r in got if r[0]) == [1, 2] and got.count((None, "a", 3)) == 2
    assert set(got) <= set(rows)
    again = [tuple(r) for r in common.one_row_of_each_id(table.repartition(3), "doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(again, key=str)


def test_near_dedup_leaves_no_tables(spark, docs):
    """What is settled on the way goes; one small table of ids stays for the result."""
    folder = Path(common.shared_dir(spark))
    before = set(folder.iterdir())
    assert near_dedup.keep_one_of_each(docs).count()
    assert len(set(folder.iterdir()) - before) <= 2


def test_fingerprints(spark, docs, none):
    rows = {r.doc_id: r for r in fingerprint.edited_documents(docs).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 7, 8, 9]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows[3].n_chars == 0 and rows[3].edited_sha256 == sha("") and rows[3].fingerprint == 0
    assert rows[9].next_key == 1 and rows[5].next_key == 7
    assert rows[5].edited_sha256 == sha(LONG[: len(LONG) - len(LONG) // 4] + "one")
    assert rows[1].fingerprint == rows[2].fingerprint
    assert fingerprint.edited_documents(none).count() == 0
    one = fingerprint.edited_documents(docs.filter("doc_id = 7")).first()
    assert one.next_key == 7 and one.edited_sha256 == sha("one")
    rng = np.random.default_rng(3)
    values = [int(v) for v in rng.integers(-(1 << 62), 1 << 62, 40)]
    values += [v ^ sum(1 << int(b) for b in rng.choice(60, k, replace=False)) for v in values for k in (1, 3, 4)]
    index = spark.createDataFrame([(v,) for v in values + [values[0], None]], "fingerprint bigint")
    found = {tuple(r) for r in fingerprint.find_within(index, index).collect()}
    bits = lambda x: (x & ((1 << 64) - 1)).bit_count()
    assert found == {(a, b, bits(a ^ b)) for a in values for b in values if bits(a ^ b) <= 3}


def test_warc(spark, tmp_path):
    big, wide = "x" * 1500, [(1, "u", None), (2, None, ""), (3, "u\nv", "é" * 600), (4, "u", "é" * 600)]
    rows = [*wide, (None, "u", big), (6, "u", big), (5, "u", big), (6, "u", big), (7, "u", "s" * 999), (8, "u", "s" * 999)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("file", F.lit(1))
    index = warc.write_archives(pages, str(tmp_path / "w"))
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(index).collect())
    assert got == sorted(
        [(1, "response", None, 0), (2, "response", None, 0), (3, "revisit", 4, 1200), (4, "response", None, 1200),
         (0, "response", None, 1500), (6, "response", None, 1500), (6, "response", None, 1500), (5, "revisit", 6, 1500),
         (7, "response", None, 999), (8, "response", None, 999)]
    )
    dated = warc.write_archives(pages, str(tmp_path / "d"), date="2024-01-31T00:00:00Z").first()
    first, second, *_ = warc.read_frames(dated.file)
    assert b"WARC-Type: warcinfo\r\n" in first and b"WARC-Type: " in second
    assert all(b"\r\nWARC-Date: 2024-01-31T00:00:00Z\r\n" in r for r in (first, second))
    row = index.filter("page_id = 4").first()
    assert warc.read_record(row.file, row.offset, row.length)[-1].decode() == "é" * 600
    assert warc.read_archives(warc.write_archives(pages.limit(0), str(tmp_path / "e"))).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    sizes = {"a": 100, "b": 10, None: 1000}
    goal = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)))
    assert goal["b"] == 20 and goal["a"] == 200 and goal[None] == pytest.approx(1.5 * 1110 - 220)


def test_sharding(spark, docs, none, tmp_path):
    clash = docs.withColumns({"shard": F.lit("x"), "_order": F.lit(1)})
    written = sharding.write_shards(clash, str(tmp_path / "s"), 3)
    assert sorted(written.columns) == sorted(clash.columns) and written.schema["shard"].dataType.simpleString() == "int"
    assert sorted(map(str, written.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    rows = sharding.slots(written).collect()
    assert len(rows) == len(ROWS) and {r.shard for r in rows} <= {0, 1, 2}
    assert sum(r.size for r in rows) == sum(len((t or "").encode()) + 8 for _, t, *_ in ROWS)
    assert sharding.slots(sharding.write_shards(none, str(tmp_path / "e"), 3)).count() == 0


def test_shards_of_repeated_rows(spark, tmp_path, monkeypatch):
    """One row many times over, and null keys: all stay, evenly, also in many parts."""
    same = spark.createDataFrame([(1, "same")] * 1000 + [(None, "same")] * 1000, "doc_id bigint, text string")
    for name, part in (("one", 1 << 40), ("many", 1000)):
        monkeypatch.setattr(sharding, "PART_BYTES", part)
        rows = sharding.slots(sharding.write_shards(same, str(tmp_path / name), 4)).collect()
        for shard in range(4):
            own = sorted(r.slot for r in rows if r.shard == shard)
            assert own == list(range(len(own))) and abs(len(own) - 500) <= 2
        assert sum(r.doc_id is None for r in rows) == 1000
        files = list((tmp_path / name).rglob("*.parquet"))
        assert len(files) > 12 if part == 1000 else len(files) == 4


def test_decontamination(spark, docs, none):
    item = " ".join(f"word{i}" for i in range(40, 70))
    items = [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "one"), (5, "not here at all")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.with_matches(docs, benchmark).collect()
    hits = sorted(((r.doc_id or 0), m.item_id, m.start, m.edits) for r in rows for m in r.matches)
    assert hits == sorted([(0, 1, 40, 0), (1, 1, 40, 0), (2, 1, 40, 0), (2, 1, 40, 0), (7, 4, 0, 0), (9, 1, 40, 1)])
    clean = decontaminate.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r[0] for r in clean.collect()) == [3, 4, 5, 8]
    assert decontaminate.with_matches(none, benchmark).count() == 0
    assert decontaminate.decontaminated(docs, benchmark.limit(0)).count() == len(ROWS)


def loop_distance(item, words):
    """Fewest edits between the item and any stretch of the words."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(words, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


@pytest.mark.parametrize("share", [0, 0.1, 0.2])
@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 6, 9, 10, 12, 15, 20, 30, 60])
def test_decontamination_recall(length, share):
    """Items of every length with so many words changed, dropped or doubled, at random places of
    texts that share words with them; the edits reported are those of a loop."""
    rng = np.random.default_rng((length, int(10 * share)))
    items = [(i, " ".join(f"w{x}{'abc'[i % 3] * (length < 4)}" for x in rng.integers(0, 3000, length))) for i in range(80)]
    index, found = decontaminate.Index(items, 0.2), 0

    def filler():
        return [f"w{x}" if x < 1500 else f"foreign{x}" for x in rng.integers(0, 3000, rng.integers(0, 40)).tolist()]

    for i, text in items:
        words = text.split()
        for _ in range(int(share * length)):
            at = int(rng.integers(len(words)))
            kind = int(rng.integers(3)) if len(words) > 1 else 0
            words[at : at + 1] = [["zz"], [], [words[at]] * 2][kind]
        body = [*filler(), *words, *filler()]
        [matches] = index.matches([" ".join(body)])
        own = [m for m in matches if m["item_id"] == i]
        found += len(own)
        for m in matches:
            item = items[m["item_id"]][1].split()
            stretch = body[m["start"] : m["start"] + m["words"]]
            assert loop_distance(item, stretch) <= m["edits"] <= 0.2 * length
            assert m["item_id"] != i or m["edits"] == loop_distance(item, body)
    assert found >= (80 if not share else 76)


def test_language_rejects_only_with_evidence(spark):
    """A long text in a script no label has goes; a short one, and a short known one, stays."""
    en = "the quick brown fox jumps over the lazy dog and runs through the green fields of home "
    rng = np.random.default_rng(4)
    other = " ".join("".join(chr(0x4E00 + x) for x in rng.integers(0, 20000, 5)) for _ in range(60))
    rows = [(1, en * 9, "en"), (2, "Avec.", None), (3, other, None), (4, other[:11], None), (5, "12 !", None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r[0] for r in language.identified(table).collect()} >= {1, 2, 4}
    assert 5 not in {r[0] for r in language.identified(table).collect()}


def test_language(docs, none):
    known = language.profiles(docs)
    rows = language.predict(docs, known).collect()
    by = {r.doc_id: r.lang_pred for r in rows}
    assert by[3] == by[4] == by[8] == "und" and by[1] == "en" and by[5] == "de"
    assert all(0 <= r.score <= 1 for r in rows)
    kept = language.identified(docs)
    assert kept.columns == docs.columns and {3, 4, 8}.isdisjoint({r[0] for r in kept.collect()})
    assert language.identified(none).count() == 0
    text = "Ein Satz, über alles. " * 9
    pieces = language.PIECE_CHARS
    language.PIECE_CHARS = 7
    cut = language.trigrams(text)
    language.PIECE_CHARS = pieces
    assert all((a == b).all() for a, b in zip(cut, language.trigrams(text), strict=True))


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (99, 1), (4, None)], "doc_id bigint, toxic int")
    always = lambda key: F.lit(True)
    rows = toxicity.scored(docs, labels, always).collect()
    assert len(rows) == len(ROWS) and {r.predicted for r in rows} == {1}
    assert {r.score for r in toxicity.scored(docs, labels.limit(0), always).collect()} == {0.0}
    assert toxicity.scored(none, labels, always).count() == 0
    both = spark.createDataFrame([(1, 1), (2, 1), (4, 0), (5, 0), (7, 0)], "doc_id bigint, toxic int")
    rows = toxicity.scored(docs, both, always).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.features("You id1ot! you IDIOT")[:2] == [0.5, pytest.approx(np.log1p(2))]


TEXTS = [
    "", " ", "plain words", "Don't we'll they've 'quoted'", "<|endoftext|> in <|startoftext|>text", "<|ENDOFTEXT|>",
    "J̌ é ́lone İ ΣΑΣ ß ﬁ", "tab\tnew\nline\r\n\x0bv\x0cf nb em　wide\x85x\x1cy",
    "漢字かな交じり文。句読点、あり", "🎉🎉 emoji👩‍👩‍👧 x", "a.b,c;d!e?f", "1234567 3.14 1,000", normalize("NFD", "äöü éàç ñ"),
]


def test_tokens_equal_the_library(docs, none):
    encoder = tokens.Encoder(tokens.tokenizer_text(VOCABULARY))
    plain = encoder.tokenizer
    want = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_all(TEXTS)]
    assert got == want
    rows = {r.doc_id: r for r in tokens.with_token_counts(docs, VOCABULARY).collect()}
    assert rows[3].n_tokens == rows[4].n_tokens == 0
    assert rows[5].n_tokens == len(plain.encode(LONG, add_special_tokens=False).ids) and rows[5].over_limit
    assert tokens.with_token_counts(none, VOCABULARY).count() == 0


def test_words_go_to_the_model_alone(monkeypatch):
    """New words of ASCII and Latin-1 letters take no pass of the whole library; only marks do."""
    encoder = tokens.Encoder(tokens.tokenizer_text(VOCABULARY))
    assert encoder.by_pieces and encoder.by_words
    passed, plain = [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda text: passed.append(text) or plain(text))
    text = "Zwölfboxkämpfer Jagen'd quer! ÉTÉ été Quiz. QUIZ quiz!"
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist() == want
    assert sorted(" ".join(passed).split()) == ["!", "'d", "."]


@pytest.mark.parametrize("seed", range(4))
def test_cut_pieces_equal_the_library(seed):
    """Words of letters, marks, digits, accents and special strings in any order."""
    rng = np.random.default_rng(seed)
    encoder = tokens.Encoder(tokens.tokenizer_text(VOCABULARY))
    pool = ["Word", "é", "ÄÖ", "ÿß", "×", "÷", "'s", "'", "<|endoftext|>", "<|", "7", "\u0301", "\u0338", "ǅ", "ª", "Σ", ".", "=", "-", " ", "\n"]
    texts = ["".join(pool[int(i)] for i in rng.integers(0, len(pool), 300)) for _ in range(20)]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_all(texts)] == want


def test_a_piece_is_looked_up_once():
    """However often a slice of texts has it; with empty, blank and huge texts beside, over two generations."""

    class Counted(dict):
        asked = 0

        def get(self, *of):
            Counted.asked += 1
            return super().get(*of)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    encoder = tokens.Encoder(tokens.tokenizer_text(VOCABULARY), chunk=4096)
    texts = ["", " \t", "one more word, " * 200, "x" * 5000, "  a. word.\x1c b\n", "\u0301 Word! word! " * 150]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for generation in range(3):
        encoder.cache, encoder.older = Counted(), encoder.cache
        Counted.asked = 0
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_all(texts)] == want
        assert Counted.asked < 60
    encoder.encode_all(["x" * (tokens.LONG_PIECE + 1)])
    assert max(map(len, encoder.cache)) <= tokens.LONG_PIECE
    assert encoder.encode_all([]) == []


def test_no_words_for_tokenizers_that_need_more():
    """Case that counts, and added tokens that begin with a letter: words stay in their pieces."""
    import json

    data = json.loads(tokens.tokenizer_text(VOCABULARY))
    cased = data | {"normalizer": {"type": "NFC"}}
    added = data | {"added_tokens": [*data["added_tokens"], data["added_tokens"][0] | {"id": 49408, "content": "ab."}]}
    for changed in (cased, added):
        encoder = tokens.Encoder(json.dumps(changed))
        assert not encoder.by_words
        text = "Ab ab. xab.y ÄB Abc.s"
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist() == want


def test_workers_give_memory_back(monkeypatch):
    """At the end of a task, and when one stops before its end."""
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.frugal(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    stopped = common.frugal(lambda batches: batches)(iter([1, 2]))
    next(stopped)
    stopped.close()
    assert len(given) == 2


@pytest.mark.parametrize("seed", range(6))
def test_spliced_chunks_equal_the_library(seed):
    rng = np.random.default_rng(seed)
    encoder = tokens.Encoder(tokens.tokenizer_text(VOCABULARY), chunk=600, overlap=256)
    pool = [t for t in TEXTS if t.strip()] + ["x" * 900, "word " * 40, "no-space-" * 80, "   \n  ", "'" * 70]
    text = " ".join(pool[int(i)] for i in rng.integers(0, len(pool), 60))
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(b"".join(encoder.chunks(text)), "<u4").tolist() == want


def test_blocks_round_trip(tmp_path):
    rng = np.random.default_rng(4)
    for n in (1, 127, 128, 129, 5000, 3 * 128 * token_files.GROUP // 2):
        values = rng.zipf(1.3, n).clip(0, 49_407).astype(np.uint32)
        values[:: 97] = rng.integers(0, 1 << 32, len(values[::97]), dtype=np.uint32)
        writer = token_files.Writer(str(tmp_path / f"t{n}.pfor"))
        writer.add(5, values[: n // 2].tobytes())
        writer.add(None, values[n // 2 :].tobytes())
        writer.close()
        reader = token_files.Reader(writer.uri)
        assert (np.concatenate(list(reader.ids())) == values).all()
        assert (np.concatenate(list(reader.ids(n // 3, n))) == values[n // 3 :]).all()
        assert [(d[1], d[3]) for d in reader.documents()] == [(5, n // 2), (None, n - n // 2)]


def test_token_files(docs, none, tmp_path):
    index = token_files.write_token_files(docs, str(tmp_path / "t"), VOCABULARY)
    rows = sorted(token_files.read_token_files(index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3, 4, 5, 7, 8, 9]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert rows[4].n_tokens == 1
    empty = token_files.write_token_files(none, str(tmp_path / "e"), VOCABULARY)
    assert token_files.read_token_files(empty).count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h")], "item_id bigint, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("n_chars", F.length("text"))
    for name, rows in (("odd", docs), ("empty", docs.limit(0))):
        rows.write.parquet(str(tmp_path / name / "documents.parquet"))
        benchmark.write.parquet(str(tmp_path / name / "benchmark.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert bool(got) == (name == "odd")


def test_simhash_of_few_words():
    assert simhash("", 3) == simhash(None, 3) == simhash(" \n", 3) == [0]
    assert simhash("A b", 3) == simhash(" a\tB ", 3) != [0]
