"""Subtitle time codes, ``HH:MM:SS,mmm`` <-> milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import DIGIT, ascii_digits, zero_padded

# Fixed value: the shape of a time code.
TIMECODE = rf"{DIGIT}{{2}}:{DIGIT}{{2}}:{DIGIT}{{2}},{DIGIT}{{3}}"

TICKS_PER_MS = 10000


def ms_to_timecode(ms: Column) -> Column:
    """Whole milliseconds (fractions cut off) as a time code; hours may pass 99."""
    whole = ms.cast("bigint")
    # Exact: whole - pmod(whole, n) is a multiple of n, so the division has no remainder.
    def floor_div(c: Column, n: int) -> Column:
        return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))

    seconds = floor_div(whole, 1000)
    minutes = floor_div(seconds, 60)
    return F.concat(
        zero_padded(floor_div(minutes, 60), 2),
        F.lit(":"),
        zero_padded(F.pmod(minutes, F.lit(60)), 2),
        F.lit(":"),
        zero_padded(F.pmod(seconds, F.lit(60)), 2),
        F.lit(","),
        zero_padded(F.pmod(whole, F.lit(1000)), 3),
    )


def timecode_to_ms(code: Column) -> Column:
    """Time code to BIGINT milliseconds; null where the text is no time code."""
    def part(i: int) -> Column:
        text = F.regexp_extract(code, rf"^({DIGIT}+):({DIGIT}+):({DIGIT}+),({DIGIT}+)$", i)
        return ascii_digits(text).try_cast("bigint")

    return _to_ms([part(i) for i in range(1, 5)])


def matched_timecode_to_ms(text: Column, at: int) -> Column:
    """The same for a text that is known to hold a 12-character code at a 1-based place."""
    places = ((0, 2), (3, 2), (6, 2), (9, 3))
    return _to_ms([F.substring(text, at + p, n).cast("bigint") for p, n in places])


def _to_ms(parts: list[Column]) -> Column:
    hours, minutes, seconds, ms = parts
    return hours * 3600000 + minutes * 60000 + seconds * 1000 + ms


def ticks_to_ms(ticks: Column) -> Column:
    """100-nanosecond ticks to (double) milliseconds."""
    return ticks.cast("double") / TICKS_PER_MS
