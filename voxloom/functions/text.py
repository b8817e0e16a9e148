"""Unicode-aware text expressions on built-in Spark SQL functions.

Spark's regular expressions are Java's, whose ``\\s``, ``\\w``, ``\\d`` and
``trim`` are ASCII-minded. The classes below give the Unicode meaning the
corpus rules need (the default voice is Tamil).

Patterns that remove a whitespace run start with one character of the run and
a short look-behind, so a long run is scanned once and not once per position.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Members of a regex character class.
WS = r"\p{IsWhite_Space}\x1c-\x1f"  # Unicode white space plus the four separators
WORD = r"\p{L}\p{N}_"  # letters, numbers and underscore, no combining marks
DIGIT = r"\p{Nd}"

STRIP = rf"\A[{WS}]++|[{WS}](?<![{WS}][{WS}])[{WS}]*+\z"


def sub(pattern: str, replacement: str):
    """A Column -> Column function that applies one regular expression."""
    return lambda c: F.regexp_replace(c, pattern, replacement)


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends.

    Most texts have none there, which their first and last character show. c is used
    more than once, so it should be a plain column.
    """
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    padded = F.rlike(ends, F.lit(f"[{WS}]"))
    return F.when(padded, F.regexp_replace(c, STRIP, "")).otherwise(c)


def zero_padded(number: Column, width: int) -> Column:
    """Digits with leading zeros; a longer number keeps all its digits."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def is_blank(c: Column) -> Column:
    """True where the text holds nothing but Unicode whitespace."""
    return ~F.rlike(c, F.lit(rf"[^{WS}]"))


def universal_newlines(c: Column) -> Column:
    """CRLF and lone CR become LF."""
    return F.regexp_replace(c, r"\r\n?", "\n")


@cache
def _digit_tables() -> tuple[str, str]:
    found = [chr(i) for i in range(128, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"]
    return "".join(found), "".join(str(unicodedata.decimal(d)) for d in found)


def ascii_digits(c: Column) -> Column:
    """Decimal digits of any script become 0-9, so that casts can read them."""
    return F.translate(c, *_digit_tables())
