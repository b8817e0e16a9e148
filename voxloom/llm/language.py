"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the elementwise product of its
letters' vectors, rotated by two, one and no places; a text is the sum of its trigrams, and a
language's prototype the sum of its texts. A document gets the language whose prototype has
the largest cosine with it. Prototypes lose their common part first, so that the letters all
languages share do not count.

Letters are Unicode letters in lower case: a to z have symbols of their own, others share 37.
Everything else separates words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import columns_from_text, free_name, frugal, slices

DIMENSIONS = 1024
SYMBOLS = 64
SEED = 11
PIECE_CHARS = 1 << 20
UNKNOWN = "und"
# The pipeline rejects a text of so many different trigrams whose cosine is within what chance
# gives, so many deviations of 1 / sqrt(DIMENSIONS). Fewer trigrams are no evidence, they stay.
MIN_TRIGRAMS = 40
CHANCE = 2.5
BINS = SYMBOLS**3


@cache
def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 no letter, 1 to 26 for a to z, 27 to 63 other letters."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = point - 96 if 97 <= point <= 122 else 27 + point * 2654435761 % (1 << 32) % 37
    return table


@cache
def _vectors() -> np.ndarray:
    """(3, SYMBOLS, DIMENSIONS): the letters' vectors, rotated for each place in a trigram.
    The separator has a vector too: word beginnings and ends count."""
    letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
    return np.stack([np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters])


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different trigram codes and their counts; texts without letters have none."""
    text, codes = text or "", []
    held = np.zeros(1, np.uint8)  # a separator before the first word
    for start in range(0, len(text), PIECE_CHARS):
        piece = text[start : start + PIECE_CHARS].lower()
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes.append(_codes(np.concatenate([held, _symbols()[points]]), False))
        held = codes[-1][1]
    codes.append(_codes(np.concatenate([held, np.zeros(1, np.uint8)]), True))
    every = np.concatenate([c[0] for c in codes])
    if not len(every):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(every) < 50_000:
        return np.unique(every, return_counts=True)
    counts = np.bincount(every, minlength=BINS)
    return np.flatnonzero(counts), counts[counts > 0]


def _codes(symbols: np.ndarray, final: bool) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes with a letter in the middle, and the last symbols for the next piece."""
    once = symbols[np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])]
    s = once.astype(np.int64)
    if len(s) < 3:
        return np.zeros(0, np.int64), once
    codes = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    return codes[s[1:-1] != 0], once if final else once[-2:]


def bundle(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the trigrams' vectors; whole numbers, so the order does not matter."""
    first, second, third = _vectors()
    total = np.zeros(DIMENSIONS)
    for s in range(0, len(codes), 4096):
        c = codes[s : s + 4096]
        bound = first[c // SYMBOLS**2] * second[c // SYMBOLS % SYMBOLS] * third[c % SYMBOLS]
        total += counts[s : s + 4096].astype(np.float32) @ bound.astype(np.float32)
    return total


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """A prototype for each language: unit length, without the part common to all.

    All texts of all rows with a language are counted. Trigram counts are summed in Spark and
    bound into vectors there; one vector for each language reaches the driver.
    """
    rows = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for part in slices(batch, 8 << 20):
                for name, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    codes, counts = trigrams(body)
                    if len(codes):
                        sums.setdefault(name, np.zeros(BINS, np.int64))[codes] += counts
            for name, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                    ["lang", "code", "n"],
                )

    counted = rows.mapInArrow(frugal(count), "lang string, code bigint, n bigint")
    summed = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            codes, counts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for name in sorted(set(names)):
                at = names == name
                made = bundle(codes[at], counts[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS)), pa.array(made)],
                    ["lang", "i", "v"],
                )

    bound = summed.mapInArrow(bind, "lang string, i bigint, v double")
    cells = bound.groupBy("lang", "i").agg(F.sum("v").alias("v")).collect()
    made: dict[str, np.ndarray] = {}
    for r in cells:
        made.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["i"]] = r["v"]
    unit = {k: v / np.linalg.norm(v) for k, v in sorted(made.items()) if v.any()}
    if len(unit) > 1:
        common = np.mean(list(unit.values()), axis=0)
        unit = {k: _unit(v - common) for k, v in unit.items()}
    return unit


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v)
    return v / length if length else v


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text",
    label: str = "lang_pred", score: str = "score", size: str | None = None,
) -> DataFrame:
    """docs with a language and a score from 0 to 1 (the cosine, negative ones as 0).

    size names a further column, if one is wanted: the number of different trigrams.

    Null texts and texts without a letter are "und" with score 0, and so is everything if no
    language was learnt. Equal cosines go to the first language by code point. Rows and other
    columns stay; an input column with the name of a result is replaced.
    """
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names])

    def make():
        def languages(texts):
            labels, scores, sizes = [], [], []
            for t in texts:
                codes, counts = trigrams(t)
                sizes.append(len(codes))
                vector = bundle(codes, counts) if len(codes) and names else None
                if vector is None:
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosine = matrix @ _unit(vector)
                best = int(cosine.argmax())
                labels.append(names[best])
                scores.append(float(np.clip(cosine[best], 0, 1)))
            return (labels, scores, sizes) if size else (labels, scores)

        return languages

    fields = f"{label} string, {score} double" + (f", {size} int" if size else "")
    return columns_from_text(docs, text, fields, make)


def identified(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """docs without those that have no letter or resemble no language that docs label.

    A text resembles none if it has MIN_TRIGRAMS different trigrams and yet no better score than
    chance gives; shorter texts in doubt stay. If no row has a language nothing can be learnt,
    and only texts without letters go.
    """
    label, score, size = (free_name(docs, name) for name in ("_lang_pred", "_lang_score", "_lang_size"))
    known = profiles(docs, text, lang)
    if not known:
        return docs.filter(F.col(text).rlike(r"\p{L}"))
    judged = predict(docs, known, text, label, score, size)
    like = (F.col(score) >= CHANCE / DIMENSIONS**0.5) | (F.col(size) < MIN_TRIGRAMS)
    return judged.filter((F.col(label) != UNKNOWN) & like).drop(label, score, size)
