"""License notices, periodic runs and the conversation trie against loops of their own."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import connect, difference
from voxloom.llm import licenses, periodic, prefix_trie

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows(spark, name):
    return [tuple(r) for r in entry.queries()[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


# --- notices -------------------------------------------------------------------------------


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_op11(spark, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    got = {r[0]: r[1:] for r in rows(spark, "op11_license_notices")}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        words = PLAIN.findall(lowered(text))
        places = [
            (i, label)
            for phrase, label in phrases.items()
            for i in range(len(words))
            if words[i : i + phrase.count(" ") + 1] == phrase.split()
        ]
        starts = [i for i, _ in places]
        n_words, n_base, first, last, base_labels, labels, score, found = got[doc_id]
        assert (n_words, n_base) == (len(words), len(places))
        assert (first, last) == (min(starts, default=None), max(starts, default=None))
        assert base_labels == ",".join(sorted({label for _, label in places}))
        assert set(base_labels.split(",")) - {""} <= set(labels.split(","))
        assert 0 <= score <= 1 and (score > 0) == bool(found) == bool(labels)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(1, len(text) - 1)
        text = rng.choice([text[:at] + "q" + text[at:], text[:at] + text[at + 1 :], text[:at] + "q" + text[at + 1 :]])
    return text


def test_bounded_edits_lose_no_notice():
    """Every stretch between word ends is compared by edit distance."""
    rng = random.Random(4)
    some = licenses.NOTICES[:8]
    scanner = licenses.Scanner(some)
    for _ in range(60):
        filler = lambda: " ".join(rng.choice(["la", "by", "cc", "license", "mit", "public"]) for _ in range(rng.randrange(5)))
        notice = rng.choice(some)[1]
        text = " ".join(f"{filler()} {edited(rng, notice, rng.randrange(4))} {filler()}".split())
        ends = [0, *[i + 1 for i, c in enumerate(text) if c == " "], len(text) + 1]
        want = {}
        for number, (_, body) in enumerate(some):
            for i, a in enumerate(ends):
                for b in ends[i + 1 :]:
                    if abs(b - 1 - a - len(body)) <= licenses.allowed_edits(body):
                        d = distance(body, text[a : b - 1])
                        if d <= licenses.allowed_edits(body):
                            want[number] = min(d, want.get(number, 99))
        got = {}
        for number, begin, end, edits in scanner.spans(text):
            assert distance(some[number][1], text[begin:end]) == edits
            got[number] = min(edits, got.get(number, 99))
        assert got == want, text


def test_notice_edges(spark):
    long = "La. " * 200_000 + "the MIT License, andé CC-BY"
    data = [
        (1, None), (2, ""), (3, long), (4, "Released under the Apache Licence, version 2"), (4, "\x00--\n"),
        (None, "gnu   GENERAL\npublic-license"), (6, "limit license emit license"), (7, "mit license mit license"),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("n_words", F.lit("x"))
    out = licenses.with_notices(docs.withColumn("score", F.lit(1)))
    got = [(r["doc_id"], r["n_words"], [(n["label"], n["first_word"], n["edits"]) for n in r["notices"]], r) for r in out.collect()]
    by = {(k, n): found for k, n, found, _ in got}
    assert by[1, 0] == by[2, 0] == by[4, 0] == [] and by[6, 4] == []
    assert by[3, 200_006] == [("mit", 200_001, 0), ("cc-by", 200_004, 0)]
    assert ("apache", 3, 1) in by[4, 7] and by[None, 4] == [("gpl", 0, 0)]
    assert by[7, 4] == [("mit", 0, 0), ("mit", 2, 0)]
    spans = [r["text"][n["start"] : n["end"]] for *_, r in got for n in r["notices"] if r["doc_id"] in (3, None)]
    assert sorted(spans) == ["CC-BY", "MIT License", "gnu   GENERAL\npublic-license"]
    assert licenses.with_notices(docs.limit(0)).count() == 0
    assert all(r["notices"] == [] for r in licenses.with_notices(docs, notices=()).collect())


# --- runs ----------------------------------------------------------------------------------


def loop_runs(words):
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                run = words[i : i + length]
                if next(p for p in range(1, q + 1) if run[p:] == run[: length - p]) == q:
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted((s, n, q) for s, n, q in out)


def test_op12(spark, texts):
    got = {r[0]: r[1:] for r in rows(spark, "op12_periodic_runs")}
    assert set(got) == set(texts)
    some = 0
    for doc_id, text in texts.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if n > 3000:
            continue  # the loop is quadratic; long texts are in the next test
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = loop_runs(words)
        some += len(runs)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert got[doc_id] == (
            len(runs),
            *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
        )
    assert some > 50


def test_runs_of_random_texts():
    rng = random.Random(3)
    for _ in range(150):
        made = []
        for _ in range(rng.randint(1, 5)):
            words = []
            for _ in range(rng.randint(0, 5)):
                unit = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 9, 17, 30]))]
                words += (unit * rng.randint(1, 9))[: rng.randint(1, 9 * len(unit))]
            made.append(words)
        assert periodic.runs_of(made) == [loop_runs(w) for w in made]


def test_run_edges(spark):
    thue = [bin(i).count("1") % 2 for i in range(1 << 16)]  # no run at all
    data = [
        (1, None), (2, " \n"), (3, "a " * 1_000_000), (4, " ".join(map(str, thue))), (5, "x y " * 3), (5, "x y " * 4),
        (None, "p q r " * 50_000), (7, "a a a a a"),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("runs", F.lit(3))
    out = periodic.with_runs(docs.withColumn("_key", F.lit(1)))
    assert out.columns == ["doc_id", "text", "_key", "runs", "collapsed"]
    got = sorted(((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()), key=str)
    long = " ".join(map(str, thue))
    assert got == sorted(
        [
            (1, [], ""), (2, [], ""), (3, [(0, 1_000_000, 1)], "a"), (4, [], long), (5, [], "x y x y x y"),
            (5, [(0, 8, 2)], "x y"), (0, [(0, 150_000, 3)], "p q r"), (7, [], "a a a a a"),
        ],
        key=str,
    )
    assert periodic.with_runs(docs.limit(0)).count() == 0


# --- trie ----------------------------------------------------------------------------------


def loop_lists(data):
    """Ordered turns of each conversation."""
    lists = {}
    for c, t, r, x in data:
        if c is not None:
            lists.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(s)] for c, s in lists.items()}


def loop_nodes(lists):
    nodes, kids, below = {}, {}, {}
    for c, s in lists.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        parts = [below[x] for x in kids.get(k, [])]
        below[k] = (sum(p[0] for p in parts) or 1, own + sum(p[1] for p in parts))
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(lists[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(k), parent, len(members), len(kids.get(k, [])), *below[k], digest))
    return sorted(out, key=lambda r: (r[1], r[0]))


def collected(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[1], r[0]))


def test_op13(spark):
    data = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    lists = loop_lists(data)
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in lists}
    rebuilt = {c: lists.get(c - c % 20, [])[: heads[c]] + s[heads[c] :] for c, s in lists.items()}
    made = entry.queries()["op13_conversation_trie"](spark, SF)
    assert collected(made) == loop_nodes(rebuilt)
    assert difference(connect(SF), entry.oracle_sql()["op13_conversation_trie"], made) is None


TURNS = [
    (c, t, "user" if t % 2 else None, f"turn {min(t, c % 4)} {c % 3 if t > 2 else ''}") for c in range(60) for t in range(c % 7)
] + [(100, None, "a", None), (100, None, "a", None), (100, 1, "b", ""), (None, 1, "x", "lost"), (101, None, None, "")]


@pytest.mark.parametrize("block", [1, 9, prefix_trie.BLOCK_TURNS])
def test_trie_blocks(spark, block):
    """Blocks of any size give the same nodes: shared ones are merged."""
    frame = spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumn("key", F.lit("clash")).withColumn("path", F.lit(1))
    lists = prefix_trie.turn_lists(frame)
    assert collected(prefix_trie.trie_nodes(lists, block)) == loop_nodes(loop_lists(TURNS))


def test_trie_without_turns(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert prefix_trie.trie_nodes(prefix_trie.turn_lists(none)).count() == 0
    lists = spark.createDataFrame([(4, []), (3, [])], f"conv_id bigint, turns {prefix_trie.TURNS}")
    digest = hashlib.sha256(b"3,4").hexdigest()
    assert collected(prefix_trie.trie_nodes(lists)) == [(3, 0, None, 2, 0, 1, 0, digest)]


def test_long_and_hot_conversations(spark):
    """One conversation of many turns, and one opening that most others share."""
    data = [(1, t, "u", f"w {t % 9}") for t in range(5000)]
    data += [(c, t, "u", "same" if t < 40 else f"{c} {t}") for c in range(2, 80) for t in range(45)]
    frame = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    got = collected(prefix_trie.trie_nodes(prefix_trie.turn_lists(frame), 300))
    assert got == loop_nodes(loop_lists(data))


def test_double_array_holds_its_sequences():
    rng = np.random.default_rng(2)
    made = sorted({tuple(rng.integers(1, 30, rng.integers(1, 6)).tolist()) for _ in range(800)})
    lengths = np.array([len(m) for m in made])
    trie = prefix_trie.pack(np.array([c for m in made for c in m]), lengths)
    base, check = trie.arrays()
    states = {(): 0}
    for m in made:
        for d in range(len(m)):
            states[m[: d + 1]] = int(base[states[m[:d]]]) + m[d]
            assert check[states[m[: d + 1]]] == states[m[:d]]
    assert len(set(states.values())) == len(states) == (check != -1).sum()
