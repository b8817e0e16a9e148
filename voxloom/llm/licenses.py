"""License scan: short notices found with a bounded number of edits.

A text is read as its words in lower case (A-Z only), joined by single spaces. A notice may
differ in `allowed_edits` inserted, deleted or replaced characters. Cut into one piece more
than that, it leaves one piece intact wherever it occurs (pigeonhole), so the pieces of all
notices are searched at once by an Aho-Corasick automaton. Each hit tells where the notice
would stand; the regex library's bounded-error matching then verifies it there, between word
ends, and gives its span and edits. An exact place needs no regular expression.

There is no shuffle: each text is read once, whole, in its own row.
"""

from __future__ import annotations

import re
from itertools import pairwise

import ahocorasick
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import columns_from_text

# The four base phrases, then further short notices and the labels they give.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
NOTICES = (
    *BASE,
    ("agpl", "gnu affero general public license"),
    ("all-rights-reserved", "all rights reserved"),
    ("apache", "licensed under the apache license version 2 0"),
    ("boost", "boost software license"),
    ("bsd", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "creative commons zero"),
    ("epl", "eclipse public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "mozilla public license"),
    ("public-domain", "released into the public domain"),
    ("unlicense", "this is free and unencumbered software"),
)

CHARS_PER_EDIT = 12  # a notice of so many characters may have one edit, of twice as many two
FOUND = "array<struct<label:string,notice:int,first_word:bigint,n_words:int,start:bigint,end:bigint,edits:int>>"

# ASCII letters in lower case and digits stay, other ASCII characters become spaces.
_PLAIN = bytes(
    c if c > 127 or chr(c).isalnum() and not chr(c).isupper() else ord(chr(c).lower()) if chr(c).isupper() else 32
    for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def allowed_edits(notice: str) -> int:
    return len(notice) // CHARS_PER_EDIT


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice in edits + 1 pieces of nearly equal length, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in pairwise(cuts)]


class Scanner:
    """Finds notices in texts; built in each task."""

    def __init__(self, notices):
        self.notices = []
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (label, notice) in enumerate(notices):
            body = b" ".join(plain_words(notice)).decode("utf-8", "surrogatepass")
            edits = allowed_edits(body)
            bounded = rf"(?<![^ ])(?:{regex.escape(body, special_only=True, literal_spaces=True)}){{e<={edits}}}(?![^ ])"
            fuzzy = regex.compile(bounded, regex.BESTMATCH) if edits else None
            self.notices.append((label, body, edits, fuzzy))
            for at, piece in pieces(body, edits) if body else ():
                seeds.setdefault(piece, []).append((number, at))
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        if seeds:
            self.automaton.make_automaton()
        self.empty = not seeds

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """notice, begin, end, edits in a text of plain words: all exact places, and of those
        with edits the best that overlap no better one of their notice."""
        if self.empty or not text:
            return []
        expected = {
            (number, end - length + 1 - at)
            for end, (length, places) in self.automaton.iter(text)
            for number, at in places
        }
        exact, near = set(), set()
        for number, begin in expected:
            _, body, edits, fuzzy = self.notices[number]
            if begin >= 0 and text.startswith(body, begin) and _stands_alone(text, begin, begin + len(body)):
                exact.add((number, begin, begin + len(body), 0))
            elif fuzzy:
                # From one word's begin to another's end, so that the window's ends are word ends.
                low = text.rfind(" ", 0, max(0, begin - edits)) + 1
                high = text.find(" ", min(len(text), begin + len(body) + edits))
                match = fuzzy.search(text, low, len(text) if high < 0 else high)
                if match:
                    near.add((number, *match.span(), sum(match.fuzzy_counts)))
        kept = sorted(exact)
        taken: dict[int, list[tuple[int, int]]] = {}
        for number, begin, end, _ in kept:
            taken.setdefault(number, []).append((begin, end))
        for number, begin, end, edits in sorted(near - exact, key=lambda s: (s[3], *s[:3])):
            own = taken.setdefault(number, [])
            if all(end <= b or e <= begin for b, e in own):
                own.append((begin, end))
                kept.append((number, begin, end, edits))
        return sorted(kept, key=lambda s: (s[1], s[0], s[2]))

    def found(self, text: str | None) -> tuple[int, list[dict]]:
        """Words of the text, and its notices with word numbers and places in the text itself."""
        words = plain_words(text)
        plain = b" ".join(words).decode("utf-8", "surrogatepass")
        rows, at, number = [], 0, 0
        for notice, begin, end, edits in self.spans(plain):
            number += plain.count(" ", at, begin)
            at = begin
            n = plain.count(" ", begin, end) + 1
            rows.append(
                {"label": self.notices[notice][0], "notice": notice, "first_word": number, "n_words": n, "edits": edits}
            )
        if rows:
            wanted = {k for r in rows for k in (r["first_word"], r["first_word"] + r["n_words"] - 1)}
            places = {k: m.span() for k, m in enumerate(_WORD.finditer(text)) if k in wanted}
            for r in rows:
                r["start"] = places[r["first_word"]][0]
                r["end"] = places[r["first_word"] + r["n_words"] - 1][1]
        return len(words), rows


def _stands_alone(text: str, begin: int, end: int) -> bool:
    return (begin == 0 or text[begin - 1] == " ") and (end == len(text) or text[end] == " ")


def with_notices(docs: DataFrame, text: str = "text", notices=NOTICES, name: str = "notices") -> DataFrame:
    """docs with n_words (bigint) and an array of the notices in each whole text.

    Each has label, notice (its number in notices), first_word and n_words (word numbers from
    0), start and end (code points of the text), edits; ordered by place. Words are stretches
    of letters and digits of ASCII and of all characters beyond. Null and empty texts have no
    words and an empty array; so have all texts if there are no notices. Repeated rows are
    judged alike. Rows and other columns stay; an input column with the name of a result is
    replaced.
    """
    notices = tuple(notices)

    def make():
        scanner = Scanner(notices)
        return lambda texts: list(zip(*map(scanner.found, texts), strict=True)) if texts else [[], []]

    return columns_from_text(docs, text, f"n_words bigint, {name} {FOUND}", make)


def exact_places(found: Column, notices: int) -> Column:
    """Those without an edit of the first so many notices."""
    return F.filter(found, lambda f: (f["edits"] == 0) & (f["notice"] < notices))


def label_list(found: Column) -> Column:
    """The different labels, sorted and joined by commas; none: the empty string."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")


def confidence(found: Column, notices=NOTICES) -> Column:
    """Agreement of the best notice, 1 less edits by its length; 0 without any."""
    lengths = F.array(*[F.lit(float(max(1, len(n)))) for _, n in notices]) if notices else F.array(F.lit(1.0))
    agreement = F.transform(found, lambda f: 1 - f["edits"] / F.get(lengths, f["notice"]))
    return F.coalesce(F.array_max(agreement), F.lit(0.0))
