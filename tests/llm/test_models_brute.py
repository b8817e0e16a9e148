"""The learnt operators against slow loops of their own."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import language, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    query = f"SELECT doc_id, text, lang, toxic FROM '{SF}/documents.parquet' LEFT JOIN '{SF}/labels.parquet' USING (doc_id)"
    return duckdb.sql(query).fetchall()


# --- language ------------------------------------------------------------------------------


def loop_trigrams(text):
    """Trigrams of letters and word ends with a letter in the middle; runs of other characters
    are one word end."""
    symbols, counted = [None], Counter()
    for c in (text or "").lower() + " ":
        letter = c if c.isalpha() else None
        if letter or symbols[-1]:
            symbols.append(letter)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        if b:
            counted[a, b, c] += 1
    return counted


def loop_bundle(counted):
    """The sum over trigrams of the product of letter vectors, rotated by 2, 1 and 0 places."""
    letters = np.random.default_rng(language.SEED).choice(
        np.array([-1, 1], np.int8), (language.SYMBOLS, language.DIMENSIONS)
    )

    def vector(letter):
        if letter is None:
            return letters[0]
        code = ord(letter)
        return letters[code - 96 if "a" <= letter <= "z" else 27 + code * 2654435761 % (1 << 32) % 37]

    total = np.zeros(language.DIMENSIONS)
    for (a, b, c), n in counted.items():
        total += n * (np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)).astype(float)
    return total


def unit(v):
    return v / math.sqrt(sum(x * x for x in v)) if v.any() else v


def test_languages_by_loops(spark, docs):
    sums = defaultdict(Counter)
    for _, text, lang, _ in docs:
        if lang is not None:
            sums[lang].update(loop_trigrams(text))
    prototypes = {k: unit(loop_bundle(v)) for k, v in sums.items()}
    common = sum(prototypes.values()) / len(prototypes)
    prototypes = {k: unit(v - common) for k, v in prototypes.items()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    known = language.profiles(table)
    assert sorted(known) == sorted(prototypes)
    for name, v in known.items():
        assert np.allclose(v, prototypes[name], atol=1e-9)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(table.select("doc_id", "text"), known).collect()}
    for doc_id, text, *_ in docs:
        counted = loop_trigrams(text)
        if not counted:
            assert got[doc_id] == ("und", 0.0)
            continue
        own = unit(loop_bundle(counted))
        cosines = {k: float(v @ own) for k, v in prototypes.items()}
        assert got[doc_id][0] == max(sorted(cosines), key=cosines.get)
        assert got[doc_id][1] == pytest.approx(min(1, max(0, max(cosines.values()))), abs=1e-6)


# --- toxicity ------------------------------------------------------------------------------


def loop_features(text):
    """Some of the features, counted word by word."""
    words = (text or "").split()
    if not words:
        return None
    cores = [w.strip(toxicity.STRIP) for w in words]
    lows = [c.lower() for c in cores]
    abusive = [i for i, w in enumerate(lows) if w in toxicity.LEXICON]
    hidden = []
    for i, (core, low) in enumerate(zip(cores, lows, strict=True)):
        if low in toxicity.LEXICON or low in toxicity.SECOND_PERSON or not toxicity.OBFUSCATED.match(core):
            continue
        plain = re.sub(r"[@$!*|€+#%.\-_]", "", low.translate(toxicity.LOOKALIKE))
        if plain in toxicity.LEXICON or re.sub(r"[@$!*|€+#%.\-_]", "", low) in toxicity.LEXICON:
            hidden.append(i)
    persons = [i for i, w in enumerate(lows) if w in toxicity.SECOND_PERSON]
    hits = sorted(abusive + hidden)
    near = sum(any(abs(h - p) <= toxicity.NEAR for p in persons) for h in hits)
    upper = sum("A" <= c <= "Z" for c in text)
    letters = max(1, upper + sum("a" <= c <= "z" for c in text))
    n = len(words)
    return {
        "lexicon_density": len(hits) / n, "lexicon_count": math.log1p(len(hits)), "near_second_person": near / n,
        "second_person": len(persons) / n, "capitals": upper / letters, "exclamations": text.count("!") / n,
        "questions": text.count("?") / n, "obfuscated_lexicon": len(hidden) / n, "log_words": math.log1p(n),
        "shouted_words": sum(len(c) > 2 and c.isupper() for c in cores) / n,
    }


def test_features_by_loops(docs):
    texts = [t for _, t, *_ in docs] + [
        "You IDIOT!! you st*pid f0ol, go away?", "id1ot a b c d e f you", "tu es un crétin, salaud", "!!! ??? ...", "a b",
    ]
    seen = Counter()
    for text in texts:
        made = dict(zip(toxicity.FEATURES, toxicity.features(text), strict=False))
        want = loop_features(text)
        if want is None:
            assert not any(made.values())
            continue
        for name, value in want.items():
            assert made[name] == pytest.approx(value, abs=1e-12), (name, text)
            seen[name] += value > 0
    assert all(seen[name] for name in ("near_second_person", "obfuscated_lexicon", "shouted_words", "questions"))


def test_learnt_lexicon_by_loops(spark, docs, monkeypatch):
    """Terms of label 1 by texts, counted term by term, for each half and for both."""
    monkeypatch.setattr(toxicity, "MIN_TEXTS", 2)
    monkeypatch.setattr(toxicity, "MIN_RATIO", 3)
    monkeypatch.setattr(toxicity, "MAX_TERMS", 100_000)
    rows = [(i % 2, text, float(toxic)) for i, (_, text, _, toxic) in enumerate(docs) if toxic is not None]
    table = spark.createDataFrame(rows, "half int, _text string, label double")
    want = Counter()
    for half, least in ((0, 1), (1, 1), (2, 2)):
        counts, sizes = {0: Counter(), 1: Counter()}, Counter()
        for own, text, label in rows:
            if half in (own, 2):
                words = {w.strip(toxicity.STRIP).lower() for w in (text or "").split()}
                counts[int(label)].update(words | {f"{w[: toxicity.BEGINNING]}*" for w in words if len(w) > toxicity.BEGINNING})
                sizes[int(label)] += 1
        for term, ones in counts[1].items():
            ratio = ones * max(sizes[0], 1) / (max(sizes[1], 1) * (counts[0][term] + 1))
            if term and ones >= least and ratio >= 3:
                want[term] |= 1 << half
    got = toxicity.learnt_lexicons(table.select("_text", F.col("label"), "half"))
    assert len(want) > 100 and {t: (got.get(t), want[t]) for t in got.keys() | want.keys() if got.get(t) != want.get(t)} == {}
