"""Benchmark decontamination: passages of documents within an edit distance of a benchmark item.

Words are letters and digits in lower case. Item-sized windows of words are embedded by the
CGK random walk: at step j the pointer's word is the output, and the pointer moves on by one
random bit that depends on j and the word. Windows at a small edit distance walk together
again after an edit, so they agree in most outputs. Each of several repetitions draws new
random bits and samples some steps; windows that agree in all sampled steps of a repetition
are candidates. A candidate is then verified: an item occurs in a document if some stretch of
its words is within max_edits x (words of the item) insertions, deletions and substitutions.

Windows are as long as the item, WINDOW words at most, and stand at every word of items and
documents. The averaging argument: if an item occurs with a share e of edits, some window of
it has at most that share, so document windows with more foreign words (that no item has) than
that are not walked, nor those without a few words of an item in a row, which so few edits leave
intact somewhere. Pairs of windows must have enough words in common before they are verified. How often a length is repeated follows from TARGET_RECALL: repetitions()
tries random windows with as many substitutions, insertions and deletions as max_edits allows
and takes the least number that finds the target's share of them. A passage longer than a
window has several, most of them with fewer edits. Items too short for any edit are looked up
by their whole words.

Only the benchmark is broadcast, in blocks of at most BLOCK_ITEMS items; documents are read
once for each block and never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import columns_from_text, free_name

WINDOW = 12
MAX_EDITS = 0.2
TARGET_RECALL = 0.97  # of single windows with the most edits
SAMPLED = 3  # steps of each repetition
MOST_REPETITIONS = 64
BLOCK_ITEMS = 20_000
SEED = 7
GRAM = 3  # a document window holds so many words of an item in a row, or as many as edits must leave
PAIRS = 1 << 16  # pairs of windows compared at once
SLICE = 1 << 20  # bytes of texts that are searched together
PIECE_WORDS = 1 << 17  # a long text is searched in overlapping pieces
TRIES = 1000  # windows that the repetitions are derived from

WORD = re.compile(r"[^\W_]+")
MATCHES = "array<struct<item_id:bigint,start:bigint,words:int,edits:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def ends_of(parts: list[np.ndarray]) -> list[int]:
    return np.cumsum([len(p) for p in parts]).tolist()


def window_edits(length: int, max_edits: float) -> int:
    """Edits that the best window of a passage may have, at most."""
    return -int(-max_edits * length // 1) if length >= WINDOW else int(max_edits * length)


@lru_cache(maxsize=256)
def repetitions(length: int, edits: int) -> int:
    """The least number that finds TARGET_RECALL of random windows with so many edits."""
    rng, size = np.random.default_rng(1), 1 << 16
    both = np.empty((2, TRIES, length), np.int64)
    for i in range(TRIES):
        both[0, i] = rng.integers(1, size, length)
        words = both[0, i].tolist()
        for kind, place in zip(rng.integers(0, 3, edits), rng.random(edits), strict=True):
            at = int(place * len(words))
            words[at : at + (kind != 1)] = [] if kind == 2 else [int(rng.integers(1, size))]
        after = rng.integers(1, size, length).tolist()  # what follows the passage
        both[1, i] = (words + after)[:length]
    starts = np.arange(2 * TRIES) * length
    found = np.zeros(TRIES, bool)
    for n, key in enumerate(_Walk(length, MOST_REPETITIONS).keys(both.reshape(-1), starts, size), 1):
        found |= key[:TRIES] == key[TRIES:]
        if found.mean() >= TARGET_RECALL:
            return n
    return MOST_REPETITIONS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Whole:
    """Windows that must be equal: one key of all words."""

    def __init__(self, length: int):
        self.length = length

    def keys(self, codes: np.ndarray, starts: np.ndarray, size: int):
        key = np.zeros(len(starts), np.uint64)
        for step in range(self.length):
            key = _mix(key + codes[starts + step].astype(np.uint64) + np.uint64(step + 1))
        yield key


class _Walk:
    """The repetitions' random walks over windows of one length.

    The pointer moves half a word a step and stays on the window's last word when it gets
    there, so the steps that tell windows apart are the first 2 x length; some are sampled.
    """

    def __init__(self, length: int, times: int):
        self.length = length
        rng = np.random.default_rng((SEED, length))
        self.seeds = rng.integers(0, 1 << 63, MOST_REPETITIONS, dtype=np.uint64)[:times]
        steps = 2 * length
        self.samples = [np.sort(rng.choice(steps, min(SAMPLED, steps), replace=False)) for _ in range(times)]

    def keys(self, codes: np.ndarray, starts: np.ndarray, size: int):
        """For each repetition a 64-bit key of the windows that begin at these places.

        size is above every word number; the random bits of a word are its row of a table.
        """
        numbers = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        last = starts + (self.length - 1)
        for seed, sample in zip(self.seeds, self.samples, strict=True):
            random = _mix(numbers + seed)[codes] if len(codes) < 8 * len(starts) else None
            table = None if random is not None else _mix(numbers + seed)
            at = starts.copy()
            key = np.full(len(starts), seed, np.uint64)
            sampled = set(sample.tolist())
            for step in range(max(sampled) + 1):
                here = codes[at]
                if step in sampled:
                    key *= np.uint64(0xD6E8FEB86659FD93)
                    key += here.astype(np.uint64) + np.uint64(step + 1)
                bits = random[at] if table is None else table[here]
                at += ((bits >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
                np.minimum(at, last, out=at)
            yield _mix(key)


class Index:
    """The windows of a block of items; part of the task's closure, so plain data only."""

    def __init__(self, items: list[tuple[int, str]], max_edits: float):
        self.max_edits = max_edits
        # Foreign words (and edits) that a window of so many words may have.
        self.most = {n: window_edits(n, max_edits) for n in range(1, WINDOW + 1)}
        self.words = {i: w for i, t in items if (w := words_of(t))}
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for ws in self.words.values() for w in ws}), 1)}
        self.coded = {i: self.code(w) for i, w in self.words.items()}
        self.tables, self.windows, self.grams = {}, {}, {}
        by_length = defaultdict(list)
        for i, codes in self.coded.items():
            by_length[min(WINDOW, len(codes))].append(i)
        for length, own in by_length.items():
            every, places, starts, at = [], [], [], 0
            for i in own:
                n = len(self.coded[i])
                places += [(i, k) for k in range(n - length + 1)]
                starts += range(at, at + n - length + 1)
                every.append(self.coded[i])
                at += n
            edits = self.most[length]
            walk, tables = (_Walk(length, repetitions(length, edits)) if edits else _Whole(length)), []
            codes = np.concatenate(every)
            size = self.intact(length)
            places_of_grams = np.concatenate([np.arange(e - len(c), e - size + 1) for c, e in zip(every, ends_of(every), strict=True)])
            self.grams[length] = np.unique(self._grams(codes, places_of_grams, size))
            self.windows[length] = codes[np.array(starts, np.int64)[:, None] + np.arange(length)]
            for key in walk.keys(codes, np.array(starts, np.int64), len(self.vocabulary) + 1):
                order = np.argsort(key, kind="stable")
                tables.append((key[order], order))
            self.tables[length] = (walk, places, tables)

    def code(self, words: list[str]) -> np.ndarray:
        """Word numbers; 0 is any word that no item has."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def intact(self, length: int) -> int:
        """Words in a row that the edits of a window leave together somewhere (pigeonhole)."""
        edits = self.most[length]
        return min(GRAM, -(-(length - edits) // (edits + 1)))

    def _grams(self, codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        base, key = len(self.vocabulary) + 1, np.zeros(len(starts), np.int64)
        for k in range(size):
            key = key * base + codes[starts + k]
        return key

    def _known_grams(self, codes: np.ndarray, foreign: np.ndarray, length: int) -> np.ndarray:
        """For each place whether words of an item of this length stand there, so many as stay
        together. The last places of codes are a gap."""
        size, known = self.intact(length), self.grams[length]
        found = np.zeros(len(codes), bool)
        starts = np.flatnonzero(foreign[size:] == foreign[:-size])
        key = self._grams(codes, starts, size)
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        found[starts] = known[at] == key
        return found

    def matches(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text the items that occur in it, each once, at the place with the fewest
        edits found. The windows of all texts are walked together."""
        coded = [self.code(words_of(t)) for t in texts]
        begins = np.cumsum([0] + [len(c) + WINDOW for c in coded])
        found: list[dict[int, tuple]] = [{} for _ in texts]
        tried: dict[tuple, list] = defaultdict(list)
        for doc, item, start in self._candidates(coded, begins):
            n, codes = len(self.coded[item]), coded[doc]
            slack = int(self.max_edits * n)
            best = found[doc].get(item)
            if best and best[0] == 0 or any(abs(start - s) <= slack // 2 for s in tried[doc, item]):
                continue
            tried[doc, item].append(start)
            # The passage may begin slack words beside the place, which may be slack / 2 off the one skipped.
            low = max(0, start - 2 * slack)
            edits, first, last = occurrence(self.coded[item], codes[low : max(0, start + n + 2 * slack)])
            if edits <= slack and (best is None or (edits, low + first) < best[:2]):
                found[doc][item] = (edits, low + first, last - first)
        return [
            [{"item_id": i, "start": s, "words": n, "edits": e} for i, (e, s, n) in sorted(f.items())]
            for f in found
        ]

    def _candidates(self, coded: list[np.ndarray], begins: np.ndarray) -> list[tuple]:
        """Text, item and the place where the item would begin, each once, in order."""
        seen = set()
        gap = np.zeros(WINDOW, np.int64)
        codes = np.concatenate([x for c in coded for x in (c, gap)] or [gap])
        starts = np.concatenate([np.arange(b, b + len(c)) for b, c in zip(begins, coded, strict=False)] or [gap[:0]])
        foreign = np.concatenate([[0], np.cumsum(codes == 0)])
        for length, (walk, places, tables) in self.tables.items():
            pairs, size = [], self.intact(length)
            hits = np.concatenate([[0], np.cumsum(self._known_grams(codes, foreign, length))])
            own = starts[foreign[starts + length] - foreign[starts] <= self.most[length]]
            own = own[hits[own + length - size + 1] > hits[own]]
            for s in range(0, len(own), PIECE_WORDS):
                part = own[s : s + PIECE_WORDS]
                keys = walk.keys(codes, part, len(self.vocabulary) + 1)
                for key, (known, order) in zip(keys, tables, strict=True):
                    low = np.searchsorted(known, key, "left")
                    count = np.searchsorted(known, key, "right") - low
                    hit = np.flatnonzero(count)
                    cuts = np.searchsorted(np.cumsum(count[hit]), np.arange(PAIRS, count.sum(), PAIRS))
                    for some in np.split(hit, np.unique(cuts)):
                        n = count[some]
                        at = np.repeat(part[some], n)
                        nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                        window = order[np.repeat(low[some], n) + nth]
                        pairs.append(self._alike(codes, at, window, length))
            if pairs := [p for p in pairs if p.size]:
                at, window = np.unique(np.concatenate(pairs, axis=1), axis=1)
                docs = np.searchsorted(begins, at, "right") - 1
                for doc, place, w in zip(docs.tolist(), (at - begins[docs]).tolist(), window.tolist(), strict=True):
                    item, offset = places[w]
                    seen.add((doc, item, place - offset))
        return sorted(seen)

    def _alike(self, codes: np.ndarray, at: np.ndarray, window: np.ndarray, length: int) -> np.ndarray:
        """The pairs of a text's and an item's window with so many common words that edits do
        not rule them out."""
        mine = codes[at[:, None] + np.arange(length)]
        other = self.windows[length][window]
        common = np.zeros(len(at), np.int64)
        for k in range(length):
            common += (mine == other[:, k : k + 1]).any(axis=1)
        keep = common >= length - self.most[length]
        return np.stack([at[keep], window[keep]])


def occurrence(item: np.ndarray, codes: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits between the item and any stretch of the words, and the stretch.

    Word 0 (no item has it) equals nothing.
    """
    n = len(codes)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    for word in item:
        step = (codes != word).astype(np.int64)
        new = np.empty(n + 1, np.int64)
        origin = np.empty(n + 1, np.int64)
        new[0], origin[0] = cost[0] + 1, begin[0]
        diagonal, above = cost[:-1] + step, cost[1:] + 1
        better = diagonal <= above
        new[1:], origin[1:] = np.where(better, diagonal, above), np.where(better, begin[:-1], begin[1:])
        # Words that only the document has: a running minimum of cost minus place.
        slope = new - np.arange(n + 1)
        low = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == low, np.arange(n + 1), 0))
        new, origin = low + np.arange(n + 1), origin[source]
        cost, begin = new, origin
    last = int(cost.argmin())
    return int(cost[last]), int(begin[last]), last


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_edits: float = MAX_EDITS,
    name: str = "matches",
) -> DataFrame:
    """docs with an array column: the benchmark items that occur in the text, ascending.

    Each match has item_id, start (word number), words (length of the passage), edits. Null
    and empty texts have none; null or empty items and items with a null id match nothing; of
    items that repeat an id the smallest text counts. Rows and other columns stay as they
    are. An empty benchmark matches nothing.
    """
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t"))
    items = items.filter(F.col("i").isNotNull() & F.col("t").isNotNull())
    items = items.groupBy("i").agg(F.min("t").alias("t"))
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    parts = []
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block)
        listed = sorted((r["i"], r["t"]) for r in own.collect())

        def make(listed=listed):
            index = Index(listed, max_edits)
            return lambda texts: [index.matches(texts)]

        parts.append(f"{name}_{block}" if blocks > 1 else name)
        docs = columns_from_text(docs, text, f"{parts[-1]} {MATCHES}", make, SLICE)
    if blocks > 1:
        docs = docs.withColumn(name, F.array_sort(F.concat(*parts))).drop(*parts)
    return docs


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs without the documents in which an item occurs; no shuffle."""
    name = free_name(docs, "_matches")
    return with_matches(docs, benchmark, text, name=name, **options).filter(F.size(name) == 0).drop(name)
