"""SimHash fingerprints of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import columns_from_text, word_blocks

SEED = 42  # of the shingle hash


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of so many words, repeats included, in blocks of bounded size.

    A text of fewer words is one shingle, one without words has none.
    """
    held: list[bytes] = []
    seen = 0
    for block in word_blocks(text):
        held += block
        seen += len(block)
        if len(held) >= words:
            yield _hashes(held, words)
            held = held[len(held) - words + 1 :]
    if 0 < seen < words:
        yield _hashes(held, len(held))


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    return np.array(
        [digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)], dtype=np.uint64
    )


def mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """An independent hash of each hash; lane 0 leaves it as it is (splitmix64 otherwise)."""
    if lane == 0:
        return hashes
    x = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, lowest first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def packed(bits: np.ndarray) -> int:
    """Boolean bits, lowest first, as a signed 64-bit integer."""
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def simhash(text: str | None, words: int, lanes: int = 1) -> list[int]:
    """Bits set in over half of the shingle hashes, 64 for each lane; no words: zero."""
    counts, total = np.zeros((lanes, 64), np.int64), 0
    for hashes in shingle_hashes(text, words):
        total += len(hashes)
        for lane in range(lanes):
            counts[lane] += votes(mixed(hashes, lane))
    return [packed(2 * c > total) for c in counts]


def fingerprints(df: DataFrame, text: str, words: int, lanes: int = 1) -> DataFrame:
    """Append f0, f1, ... (bigint): the SimHash of each whole text. Null counts as empty."""

    def make():
        return lambda texts: list(zip(*[simhash(t, words, lanes) for t in texts], strict=True))

    fields = ", ".join(f"f{i} bigint" for i in range(lanes))
    return columns_from_text(df, text, fields, make)


def hex_digits(value: Column) -> Column:
    """A bigint's 64 bits as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def signed(mask: int) -> int:
    """An unsigned 64-bit pattern as the bigint with the same bits."""
    return mask - (1 << 64) if mask >= 1 << 63 else mask
