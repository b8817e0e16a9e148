"""Periodic runs of words: seeds by k-grams, extended along diagonals.

A run has smallest period q and at least max(6, 4 q) words, so its words equal those q places
further on for max(6, 4 q) - q places at least. Lags from 2^j to 2^(j+1) - 1 are one level;
its k-grams have the length that its smallest lag guarantees (5 for lag 1, then 3 * 2^j).
That is no less than any lag of the level, so within a run a k-gram's next occurrence is one
period away exactly: of the occurrences of a k-gram in a text only neighbours are paired, at
most one pair for each place and level, and the lag of a pair is the smallest period of the
run around it. A pair is extended to both sides as long as words agree; a table of the place
that was reached for each lag passes over further pairs inside the same stretch.

Longer k-grams are hashed from two halves. A place whose k-gram does not recur in its text
has no longer one that does, so later levels sort the few places that are left.

Texts of a slice are worked on together, as one array of word numbers. No shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from voxloom.llm.common import columns_from_text
from voxloom.llm.simhash import mixed

MIN_WORDS = 6
MIN_PERIODS = 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FIRST_STEP = 64  # words that an extension compares at first; then twice as many each time


def least_length(period: int) -> int:
    return max(MIN_WORDS, MIN_PERIODS * period)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    return mixed(left * np.uint64(0x9FB21C651E98DF25) + mixed(right, 2), 1)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    made = mixed(codes.astype(np.uint64), 3)
    whole = made[: len(made) - size + 1]
    for k in range(1, size):
        whole = _joined(whole, made[k : len(made) - size + 1 + k])
    return whole


def periodic_runs(codes: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int, int]]:
    """text, start, length, period of the runs of consecutive texts; sorted.

    codes are the word numbers of all texts, one after the other, lengths their words.
    """
    n = len(codes)
    longest = int(lengths.max()) if len(lengths) else 0
    if longest < MIN_WORDS:
        return []
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(lengths)), lengths)
    left = ends[text] - np.arange(n)  # words from a place to the end of its text
    found: list[tuple[int, int, int, int]] = []
    places = np.flatnonzero(left >= MIN_WORDS - 1)
    level, size, grams = 0, least_length(1) - 1, None
    while least_length(1 << level) <= longest and len(places):
        if level < 2:
            grams = _grams(codes, size)
        else:
            grams = _joined(grams[: len(grams) - size // 2], grams[size // 2 :])
        places = places[left[places] >= size]
        own = grams[places]
        order = np.argsort(own, kind="stable")
        at, key = places[order], own[order]
        again = (key[1:] == key[:-1]) & (text[at[1:]] == text[at[:-1]])
        recurs = np.zeros(len(at), bool)
        recurs[1:] |= again
        recurs[:-1] |= again
        lag = at[1:] - at[:-1]
        pair = again & (lag >> level == 1)
        found += _extended(codes, text, ends, lengths, at[:-1][pair], lag[pair], size)
        places = np.sort(at[recurs])
        level += 1
        size = least_length(1 << level) - (1 << level)
    return sorted(found)


def _extended(codes, text, ends, lengths, places, lags, size):
    """The runs around pairs of equal k-grams, lag by lag in ascending order of place."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    # Pairs at consecutive places with one lag lie in one stretch; the first stands for them.
    head = np.ones(len(places), bool)
    head[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
    reached: dict[int, int] = {}
    for place, lag in zip(places[head].tolist(), lags[head].tolist(), strict=True):
        if place < reached.get(lag, 0):
            continue
        if (codes[place : place + size] != codes[place + lag : place + lag + size]).any():
            continue  # equal hashes only
        number = int(text[place])
        end, begin = int(ends[number]), int(ends[number] - lengths[number])
        low, high, step = place, place + size, FIRST_STEP
        while high + lag < end:
            upto = min(high + step, end - lag)
            differ = np.flatnonzero(codes[high:upto] != codes[high + lag : upto + lag])
            if len(differ):
                high += int(differ[0])
                break
            high, step = upto, 2 * step
        step = FIRST_STEP
        while low > begin:
            down = max(begin, low - step)
            differ = np.flatnonzero(codes[down:low] != codes[down + lag : low + lag])
            if len(differ):
                low = down + int(differ[-1]) + 1
                break
            low, step = down, 2 * step
        reached[lag] = high
        if high - low + lag >= least_length(lag):
            yield number, low - begin, high - low + lag, lag


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """start, length, period of each text's runs, by start and period."""
    numbers: dict[bytes, int] = {}
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.fromiter(
        (numbers.setdefault(w, len(numbers)) for words in texts for w in words), np.int64, int(lengths.sum())
    )
    made: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, *run in periodic_runs(codes, lengths):
        made[text].append((run[0], run[1], run[2]))
    return made


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def with_runs(
    docs: DataFrame, text: str = "text", name: str = "runs", kept: str = "collapsed"
) -> DataFrame:
    """docs with the runs of each whole text, and the text without their repetitions.

    Words stand between ASCII white space and are compared as they are. runs is an array of
    start (word number from 0), length, period, ordered by start and period; each run is as
    long as it can be. The second column joins the kept words by single spaces. Null and empty
    texts have no runs and the empty text. Repeated rows are judged alike; rows and other
    columns stay; an input column with the name of a result is replaced.
    """

    def make():
        def judge(texts):
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
            runs = runs_of(words)
            joined = [
                b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(words, runs, strict=True)
            ]
            listed = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            return listed, joined

        return judge

    return columns_from_text(docs, text, f"{name} {RUNS}, {kept} string", make)
