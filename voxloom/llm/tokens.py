"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text above CHUNK code points is encoded in overlapping chunks with offsets. Two neighbours
are spliced at a boundary that is stable in both: a word begins there, white space stands
before it, and it lies at least MARGIN from the end of the left and the beginning of the right
chunk. There the scan has no memory: the tokenizers used here normalise, split and encode the
text after white space without regard to what stands before it, and nothing before it depends
on what follows (MARGIN covers the longest special string). From there to MARGIN before the left
chunk's end both must give the same ids at the same places. If the overlap has no such place,
or the two encodings do not agree, the overlap is widened, up to the whole text.

Smaller texts are encoded by the same argument in pieces between white space: each different
piece of a batch is looked up once in a cache of bounded size, and encoded if it is not there.
Whether a vocabulary allows that is found out by encoding PROBES both ways; with others (those whose
tokens hold white space, say) every text is encoded whole or by chunks.

A new piece that begins with LETTERS (ASCII and Latin-1), and ends there or goes on with an ASCII
mark, is cut behind the letters. They are one word, which goes to the tokenizer's model alone, in
the form the library's own normaliser and splitter give each letter; the rest is a piece like
others. That needs a tokenizer that handles each letter by itself and in any case alike, ends a
word before every mark, and has no added token that begins with a letter or looks beside itself:
also found out both ways, with pairs of letters and every mark.
"""

from __future__ import annotations

import os
import re
import string
import struct
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from voxloom.llm.common import columns_from_text

CHUNK = 1 << 16  # code points
OVERLAP = 1 << 10
MARGIN = 64
CACHE_PIECES = 400_000  # in each of two generations
LONG_PIECE = 256  # longer pieces are not kept
LIMIT = 2048
SPACES = "\t\n\v\f\r "
PROBES = (
    "a b", " Ab,  c.d\n\n'tis it's\tx\r\n", "1 23 4.5 %&/ (q) <x> - \u00c4b\u00df \u0ba4\u0bae\u0bbf\u0bb4\u0bcd \u6f22\u5b57", "\u00e9 e\u0301 Z\u030c",
)
LETTERS = string.ascii_letters + "".join(chr(i) for i in range(0xC0, 0x100) if i not in (0xD7, 0xF7))
WORD_PROBES = [a + b for a in LETTERS for b in string.ascii_letters] + [LETTERS, LETTERS[::-1]]
MARK_PROBES = [f"a\u00e9{c}{rest}" for c in string.punctuation for rest in ("", "s", "Re", "1x", "'t", "\u0301")]
# LETTERS in UTF-8, then nothing or an ASCII mark.
_WORD_FIRST = re.compile(rb"((?:[A-Za-z]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)([!-/:-@\[-`{-~].*)?", re.DOTALL)


def load_tokenizer(data: str):
    """A tokenizers.Tokenizer from the text of its JSON file, one thread, no padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def tokenizer_text(path: str) -> str:
    """The file's text; a vocabulary of a few MB that goes to the tasks with their code."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=1)
def worker_encoder(data: str) -> Encoder:
    """The encoder of this Python worker; tasks that follow each other share its cache."""
    return Encoder(data)


class Encoder:
    """Exact token ids of texts, as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, data: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        if overlap < 4 * MARGIN or chunk <= 2 * overlap:
            raise ValueError("the overlap must hold four margins and the chunk two overlaps")
        self.tokenizer = load_tokenizer(data)
        self.model = self.tokenizer.model
        self.chunk, self.overlap = chunk, overlap
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        whole = [self._encode(p)[0].tolist() for p in PROBES]
        self.by_pieces = whole == [self._ids(p.encode().split()) for p in PROBES]
        self.by_words = self.by_pieces and self._words_alone()

    def _ids(self, pieces: list[bytes]) -> list[int]:
        return [i for p in pieces for i in self._encode(p.decode())[0].tolist()]

    def _words_alone(self) -> bool:
        """Whether words of LETTERS can go to the model, and pieces be cut behind them."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or split is None:
            return False
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if token.content[:1].isalnum() or token.single_word or token.lstrip or token.rstrip:
                return False
        forms = {a: [form for form, _ in split.pre_tokenize_str(normal.normalize_str(a))] for a in LETTERS}
        if any(len(f) != 1 or f != forms[a.lower()] for a, f in forms.items()):
            return False
        self.forms = str.maketrans({a: f[0] for a, f in forms.items()})
        self.plain = all(forms[a] == [a] for a in string.ascii_lowercase)
        words = [w.encode() for w in WORD_PROBES]
        marks = [w.encode() for w in MARK_PROBES]
        whole = self._encode_joined(words + marks)
        head = marks[0][:3]
        rests = self._encode_joined(sorted({w[3:] for w in marks}))
        return all(whole[w] == self._encode_word(w.lower()) for w in words) and all(
            whole[w] == self._encode_word(head) + rests[w[3:]] for w in marks
        )

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text: short ones by pieces, huge ones by chunks."""
        if not self.by_pieces:
            return [b"".join(self.chunks(t)) for t in texts]
        short = [t.encode("utf-8", "surrogatepass") if len(t) <= self.chunk else b"" for t in texts]
        made = self._by_pieces(short)
        if len(self.cache) > CACHE_PIECES:
            self.cache, self.older = {}, self.cache
        return [b"".join(self.chunks(t)) if len(t) > self.chunk else ids for t, ids in zip(texts, made, strict=True)]

    def _by_pieces(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. Arrow cuts all of them and tells the different pieces, each of which
        is looked up once; numpy puts their ids in the order of the texts."""
        if not texts:
            return []
        data = pa.array(texts, pa.large_binary())
        # As strings, unchecked: a lone surrogate is a piece like others. The cut is at \x20 and
        # \x09-\x0D only, which every tokenizer takes for white space.
        listed = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(data), *data.buffers()[1:]))
        words = listed.values.cast(pa.large_binary()).dictionary_encode()
        pieces = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.cache.get, pieces))
        if None in found:
            new = self._learn({w for w, ids in zip(pieces, found, strict=True) if ids is None})
            found = [new[w] if ids is None else ids for w, ids in zip(pieces, found, strict=True)]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        nth = words.indices.to_numpy()
        counts = sizes[nth]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(begins[nth] - ends[:-1], counts)
        places += np.arange(len(places))
        ids = flat[places].tobytes()
        cuts = (4 * ends[listed.offsets.to_numpy()]).tolist()
        return [ids[x:y] for x, y in pairwise(cuts)]

    def _learn(self, missing: set[bytes]) -> dict[bytes, bytes]:
        """The ids of pieces that the cache has not; it has those worth keeping afterwards.

        What the older generation has is renewed.
        """
        cache, older, match = self.cache, self.older.get, _WORD_FIRST.fullmatch
        new: dict[bytes, bytes] = {}
        whole: list[bytes] = []  # pieces that go through the library
        behind: dict[bytes, list[tuple[bytes, bytes]]] = {}  # rests: pieces that end in them, and their word's ids
        for w in missing:
            ids = older(w) if w else b""
            if ids is None:
                rest = None
                if not self.by_words:
                    whole.append(w)
                    continue
                if w.isalpha():
                    word = w.lower()
                elif found := match(w):
                    word, rest = found.groups()
                    word = word.lower()
                else:
                    whole.append(w)
                    continue
                ids = cache.get(word)
                if ids is None:
                    ids = older(word) or self._encode_word(word)
                    if len(word) <= LONG_PIECE:
                        cache[word] = ids
                if rest:
                    last = cache.get(rest, older(rest))
                    if last is None:
                        behind.setdefault(rest, []).append((w, ids))
                        continue
                    ids += last
            new[w] = ids
        kept = self._encode_joined(whole + [rest for rest in behind if rest not in missing])
        new.update((w, kept[w]) for w in whole)
        for rest, pieces in behind.items():
            last = kept[rest]
            if len(rest) <= LONG_PIECE:
                cache[rest] = last
            new.update((w, ids + last) for w, ids in pieces)
        cache.update(new)
        for w in new:
            if len(w) > LONG_PIECE:
                del cache[w]
        return new

    def _encode_word(self, word: bytes) -> bytes:
        """Ids of one word of LETTERS, A-Z in lower case."""
        text = word.decode()
        if not (self.plain and word.isascii()):
            text = text.translate(self.forms)
        ids = [token.id for token in self.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_joined(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Many pieces in one text; offsets tell which tokens belong to which."""
        new: dict[bytes, bytes] = {}
        for s in range(0, len(pieces), 2000):
            part = pieces[s : s + 2000]
            texts = [p.decode("utf-8", "surrogatepass") for p in part]
            lengths = np.fromiter(map(len, texts), np.int64, len(part))
            starts = np.cumsum(lengths + 1) - lengths - 1
            ids, begins = self._encode(" ".join(texts))
            cuts = np.searchsorted(begins, starts).tolist() + [len(ids)]
            data = ids.tobytes()
            for k, piece in enumerate(part):
                new[piece] = data[4 * cuts[k] : 4 * cuts[k + 1]]
        return new

    def _encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and where in the text each token begins (never descending)."""
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        begins = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(encoding))[::2]
        return np.array(encoding.ids, dtype="<u4"), begins

    def chunks(self, text: str):
        """Ids of a huge text, piece after piece, by splicing overlapping chunks."""
        start, end = 0, min(len(text), self.chunk)
        ids, begins = self._encode(text[:end])
        while end < len(text):
            overlap = self.overlap
            right_at = max(start, end - overlap)
            right_end = min(len(text), right_at + self.chunk)
            right_ids, right_begins = self._encode(text[right_at:right_end])
            cut = self._seam(text, start, end, (ids, begins), right_at, (right_ids, right_begins))
            while cut is None:
                # Widen: the left chunk reaches further, the right one begins an overlap earlier.
                overlap *= 2
                end = min(len(text), end + overlap)
                ids, begins = self._encode(text[start:end])
                if end == len(text):
                    break
                right_at = max(start, end - 2 * overlap)
                right_end = min(len(text), right_at + max(self.chunk, 4 * overlap))
                right_ids, right_begins = self._encode(text[right_at:right_end])
                cut = self._seam(text, start, end, (ids, begins), right_at, (right_ids, right_begins))
            if cut is None:
                break
            yield ids[: np.searchsorted(begins, cut - start)].tobytes()
            keep = int(np.searchsorted(right_begins, cut - right_at))
            ids, begins = right_ids[keep:], right_begins[keep:] - (cut - right_at)
            start, end = cut, right_end
        yield ids.tobytes()

    def _seam(self, text, start, end, left, right_at, right) -> int | None:
        """The last place where a token begins in both chunks, white space stands before it,
        both chunks reach MARGIN beyond, and from where on both have the same tokens."""
        (ids, begins), (right_ids, right_begins) = left, right
        low, high = right_at + MARGIN if right_at > start else start + 1, end - MARGIN
        begins, right_begins = begins + start, right_begins + right_at
        mine = np.unique(begins[(begins >= low) & (begins <= high)])
        both = np.intersect1d(mine, np.unique(right_begins), assume_unique=True)
        for place in both[::-1].tolist():
            if text[place - 1] in SPACES:
                a, b = (begins >= place) & (begins <= high), (right_begins >= place) & (right_begins <= high)
                if np.array_equal(begins[a], right_begins[b]) and np.array_equal(ids[a], right_ids[b]):
                    return place
                return None
        return None


def with_token_counts(
    docs: DataFrame, tokenizer: str, text: str = "text", limit: int = LIMIT, name: str = "n_tokens"
) -> DataFrame:
    """docs with n_tokens (bigint) and over_limit (more than limit tokens).

    tokenizer is the path of any tokenizers JSON file, read on the driver. Whole texts count, of
    any length; no begin, end or other token is added; special strings inside a text are what
    the library makes of them by default. Null and empty texts have 0 tokens. Rows and other
    columns stay; an input column with the name of a result is replaced.
    """
    data = tokenizer_text(tokenizer)

    def make():
        encoder = worker_encoder(data)

        def count(texts):
            counts = [len(ids) // 4 for ids in encoder.encode_all([t or "" for t in texts])]
            return counts, [c > limit for c in counts]

        return count

    return columns_from_text(docs, text, f"{name} bigint, over_limit boolean", make)
