"""The similarity form of near-dedup against all pairs of small tables."""

from __future__ import annotations

import random

import numpy as np

from voxloom.llm import near_dedup
from voxloom.llm.components import forest, spanning

SCHEMA = "doc_id bigint, text string"


def components_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return dict(map(tuple, near_dedup.similar_documents(rows).collect()))


def all_pairs(texts, similarity=0.8):
    """The component of each text over the links of all pairs."""
    sets = []
    for t in texts:
        words = t.split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and len(a & sets[j]) >= similarity * len(a | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return dict(enumerate(label))


def test_repeated_line_does_not_link(spark):
    """One line rules a fingerprint that counts repeats; the sets share a fifth."""
    line = " ".join(f"line{i}" for i in range(11))
    texts = [" ".join([line] * 40 + [f"own{d}x{i}" for i in range(20)]) for d in range(6)]
    assert components_of(spark, texts) == all_pairs(texts) == {d: d for d in range(6)}


def test_each_pair_in_a_large_group_links(spark):
    """All are at about 0.7 to each other, and each has one partner at about 0.9."""
    base = [f"base{i}" for i in range(170)]
    texts = []
    for pair in range(560):
        own = [f"pair{pair}x{i}" for i in range(32)]
        texts += [" ".join(base + own + [f"one{pair}x{v}x{i}" for i in range(4)]) for v in range(2)]
    assert components_of(spark, texts) == {d: d - d % 2 for d in range(len(texts))}


def test_pairs_at_the_threshold_link(spark):
    """Repeats do not count, and no similar pair is lost, however close to the threshold."""
    rng = random.Random(5)
    texts = []
    for d in range(150):
        words = [f"d{d}w{i}" for i in range(rng.choice([9, 14, 44, 104]))]
        cut = rng.randint(1, max(1, len(words) // 6))
        texts += [" ".join(words), " ".join(words[:-cut] + [f"new{d}x{i}" for i in range(rng.randint(0, cut))])]
    line = [f"l{i}" for i in range(10)]
    words = line + [f"r{i}" for i in range(90)]
    texts += [" ".join(words), " ".join(line * 30 + words)]
    want = all_pairs(texts)
    assert sum(d != c for d, c in want.items()) > 50
    assert want[len(texts) - 1] == len(texts) - 2
    assert components_of(spark, texts) == want


def test_bands_find_pairs_at_the_threshold():
    """Random sets that share just 0.8: every pair has a key in common."""
    rng = np.random.default_rng(9)
    for size in (9, 45, 450, 4500):
        for _ in range(300 if size < 4500 else 30):
            own = rng.integers(0, 1 << 63, size + size // 9 * 2, dtype=np.uint64)
            other = size // 9
            a, b = np.unique(own[:size]), np.unique(np.concatenate([own[: size - other], own[size : size + other]]))
            assert near_dedup.jaccard(a, b) == 0.8
            assert (near_dedup.band_keys(a) == near_dedup.band_keys(b)).any()
            one, two = (np.frombuffer(near_dedup.sketch(x), np.uint8) for x in (a, b))
            assert (one != two).sum() <= near_dedup.sketch_distance(0.8)


def test_large_group_of_varied_copies(spark):
    """A group of 400, each some edits from its neighbours: a chain of links, one component."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[: 2 * d] + [f"new{i}" for i in range(2 * d)] + words[4 * d :]) for d in range(90)]
    texts += [" ".join([*words[:-1], f"tail{d}"]) for d in range(300)]
    assert components_of(spark, texts) == all_pairs(texts)


def test_fingerprints_link_without_bands(spark, monkeypatch):
    """SimHash and deletion variants alone link near copies within 3 bits, and no others."""
    monkeypatch.setattr(near_dedup, "_shared_keys", lambda index, above: index.filter("false"))
    rng, texts = random.Random(3), []
    for d in range(30):
        words = [f"d{d}w{i}" for i in range(600)]
        for copy in range(4):
            changed = list(words)
            for edit in range(copy):
                changed[rng.randrange(600)] = f"new{d}x{copy}x{edit}"
            texts.append(" ".join(changed))
    prints = [near_dedup.set_fingerprint(near_dedup.shingle_set(t, 5)) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 3 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    found = components_of(spark, texts)
    assert found == dict(enumerate(label))
    assert sum(d != c for d, c in found.items()) >= 40


def test_fingerprints_are_verified(spark, monkeypatch):
    """Documents that a fingerprint would link, but that share less than 0.8, stay apart."""
    links = lambda nodes: nodes.selectExpr("node AS a", "CAST(0 AS BIGINT) AS b").filter("a > 0")
    monkeypatch.setattr(near_dedup, "_print_links", links)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(words[:50] + [f"x{i}" for i in range(50)])]
    assert components_of(spark, texts) == all_pairs(texts) == {0: 0, 1: 0, 2: 2}


def test_spanning_pairs():
    rng = np.random.default_rng(4)
    for _ in range(50):
        i, j = rng.integers(0, 60, (2, 45))
        some = spanning(60, i, j)
        label = forest(60, i, j)
        assert (forest(60, i[some], j[some]) == label).all()
        assert len(some) == 60 - len(np.unique(label))
