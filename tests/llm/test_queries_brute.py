"""The registered queries against loops of their own, over all rows of a small table."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import connect, difference
from voxloom.llm.mixing import cyclic_weights, targets

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name):
    return [tuple(r) for r in entry.queries()[name](spark, SF).collect()]


def components(keys, linked):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_op1(spark, docs):
    def fingerprint(text):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {d: fingerprint(t) for d, t, *_ in docs}
    ids = list(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = components(ids, links)
    assert sorted(rows(spark, "op1_simhash_near_dedup")) == [(d, f"{prints[d]:016x}", want[d]) for d in ids]


def loop_fingerprint(text):
    """Word pairs (one word alone), each with 1 + ln(times) in sixteenths, vote on 64 bits."""
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    terms = [" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))] if words else []
    weight = {t: math.floor(16 * (1 + math.log(n))) for t, n in Counter(terms).items()}
    votes = [0] * 64
    for term, w in weight.items():
        h = xxhash.xxh64_intdigest(term.encode(), 42)
        for b in range(64):
            votes[b] += w if h >> b & 1 else -w
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_op2(spark, docs):
    texts = [t or "" for _, t, *_ in docs]
    following = texts[1:] + texts[:1]
    got = {r[0]: r[1:] for r in rows(spark, "op2_document_fingerprints")}
    assert len(got) == len(docs)
    near = []
    prints = [int(got[d][2], 16) for d, *_ in docs]
    for i, ((d, *_), text, after) in enumerate(zip(docs, texts, following, strict=True)):
        n = len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        n_chars, sha, fp, edited_fp, near_edited, near_next, n_within = got[d]
        assert (n_chars, sha) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert fp == f"{loop_fingerprint(text):016x}" and edited_fp == f"{loop_fingerprint(edited):016x}"
        assert near_edited == 1 - (int(fp, 16) ^ int(edited_fp, 16)).bit_count() / 64
        assert near_next == 1 - (prints[i] ^ prints[(i + 1) % len(docs)]).bit_count() / 64
        within = sum((prints[i] ^ p).bit_count() <= 3 for p in prints)
        assert n_within == (within if d % 20 == 0 else None)
        near.append((near_edited, near_next))
    assert np.mean([a > b for a, b in near]) > 0.97


def test_op3(spark):
    assert difference(connect(SF), entry.oracle_sql()["op3_warc_archives"], entry.queries()["op3_warc_archives"](spark, SF)) is None


def test_op4(spark, docs):
    size = {d: len(WORD.findall(t or "")) for d, t, *_ in docs}
    total = defaultdict(int)
    for d, _, _, s in docs:
        total[s] += size[d]
    goal = targets(dict(total), cyclic_weights(list(total)))
    assert abs(sum(goal.values()) - 1.5 * sum(total.values())) < 1e-6 * sum(total.values())
    got = rows(spark, "op4_source_mixture")
    taken = defaultdict(int)
    source = {d: s for d, _, _, s in docs}
    assert len(got) == len(docs)
    for d, n, source_size, target, t in got:
        assert (n, source_size) == (size[d], total[source[d]])
        assert target == pytest.approx(goal[source[d]])
        assert 0 <= t <= 2 * n
        taken[source[d]] += t
    assert all(taken[s] == int(goal[s] + 1e-9) for s in goal)
    assert sorted(got) == sorted(rows(spark, "op4_source_mixture"))


def test_op5(spark, docs):
    """Every item that stands in a document word by word is found, and every find is one."""
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    inside = {(d, i) for d, t, *_ in docs for i, b in items if f" {' '.join(words(b))} " in f" {' '.join(words(t))} "}
    got = rows(spark, "op5_benchmark_leaks")
    assert inside and inside == {(d, i) for d, i, *_, edits in got if edits == 0}
    text = {d: words(t) for d, t, *_ in docs}
    item = {i: words(b) for i, b in items}
    for d, i, start, n, edits in got:
        assert levenshtein(item[i], text[d][start : start + n]) == edits <= 0.2 * len(item[i])


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_op6(spark, docs):
    got = rows(spark, "op6_histogram_shards")
    sums, slots = defaultdict(int), defaultdict(list)
    text = {d: (t or "").encode() for d, t, *_ in docs}
    assert sorted(r[0] for r in got) == [d for d, *_ in docs]
    for d, size, crc, law, shard, slot, grown in got:
        assert (size, crc, law, grown) == (len(text[d]) + 8, zlib.crc32(text[d]), "bytes", None)
        sums[shard] += size
        slots[shard].append(slot)
    assert sorted(sums) == list(range(24))
    largest = max(len(t) + 8 for t in text.values())
    mean = sum(sums.values()) / 24
    assert all(abs(s - mean) <= largest for s in sums.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op7_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    got = [tuple(r) for r in entry.queries()["op7_toxicity"](spark, sf).collect()]
    assert len(got) == 10_000
    assert all(held == (zlib.crc32(str(d).encode()) % 5 == 0) and p == (s >= 0.5) and 0 <= s <= 1 for d, held, s, p in got)
    judged = [(s, truth[d]) for d, held, s, _ in got if held and d in truth]
    ones, zeros = [s for s, t in judged if t], [s for s, t in judged if not t]
    area = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    assert area > 0.9
    assert np.mean([(s >= 0.5) == bool(t) for s, t in judged]) > 0.96


def test_op8_held_out(spark, docs):
    lang = {d: x for d, _, x, _ in docs}
    got = rows(spark, "op8_language_id")
    assert all(held == (zlib.crc32(str(d).encode()) % 4 == 2) for d, held, *_ in got)
    right = [lang[d] == p for d, held, p, _ in got if held]
    assert np.mean(right) > 0.98


def token_ids(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {d: tokenizer.encode(t or "", add_special_tokens=False).ids for d, t, *_ in docs}


def test_op9_and_op10(spark, docs):
    ids = token_ids(docs)
    text = {d: t or "" for d, t, *_ in docs}
    got = sorted(rows(spark, "op9_token_counts"))
    assert got == [(d, len(text[d].encode()), len(ids[d]), len(ids[d]) > 2048) for d in ids]
    start, want = 0, []
    for d in ids:
        full = [*ids[d], 2]
        want.append((d, start, len(full), zlib.crc32(np.array(full, "<u4").tobytes())))
        start += len(full)
    assert sorted(rows(spark, "op10_token_files")) == want


def shingle_set(text, k=5):
    words = [w.lower() for w in WORD.findall(text or "")]
    return frozenset(" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def test_pipeline_stages(spark, docs):
    """Language ID and decontamination keep what they should; dedup against all pairs."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, table, SF)
    known = {d for d, t, *_ in docs if t and any(c.isalpha() for c in t)}
    assert kept.columns == table.columns and {r[0] for r in kept.select("doc_id").collect()} == known

    deduped = corpus_pipeline.near_dedup(spark, table, SF)
    ids = {r[0] for r in deduped.select("doc_id").collect()}
    sets = {d: shingle_set(t) for d, t, *_ in docs}
    pairs = []
    place = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            place[x].add(d)
    for d, s in sets.items():
        for e in {e for x in s for e in place[x] if e < d}:
            if len(s & sets[e]) >= 0.8 * len(s | sets[e]):
                pairs.append((d, e))
    want = components(list(sets), pairs)
    roots = set(want.values())
    assert ids == roots
    assert deduped.columns == table.columns

    clean = {r[0] for r in corpus_pipeline.decontamination(spark, table, SF).select("doc_id").collect()}
    leaked = {r[0] for r in rows(spark, "op5_benchmark_leaks")}
    assert clean == {d for d, *_ in docs} - leaked


def test_pipeline_mixture_and_output(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = corpus_pipeline.source_mixture(spark, table, SF)
    assert mixed.columns == table.columns
    taken = {(r[0]): r[4] for r in rows(spark, "op4_source_mixture")}
    words = defaultdict(int)
    whole = {d: t for d, t, *_ in docs}
    for d, text, n_chars in mixed.select("doc_id", "text", "n_chars").collect():
        words[d] += len(WORD.findall(text))
        assert whole[d].startswith(text) and n_chars == len(text)
    assert dict(words) == {d: t for d, t in taken.items() if t}


def test_pipeline_runs(spark):
    got = [tuple(r) for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()]
    got.sort(key=lambda r: r[1])
    assert got and [n for n, _ in corpus_pipeline.STAGES][0] == "language_id"
    starts = np.cumsum([0] + [r[2] for r in got])
    assert [r[1] for r in got] == starts[:-1].tolist()
    assert [r[0] for r in got] == sorted(r[0] for r in got)
