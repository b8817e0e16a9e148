"""Tracks of an album -> order, start offsets, total length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.paths import file_name
from voxloom.functions.text import DIGIT, ascii_digits

# Fixed value: silence between two tracks.
GAP_MS = 500

BLOCK_DIGITS = 4  # tracks whose numbers differ in so many last digits are one block
NAME_CHARS = 12  # so are unnumbered ones whose names begin alike for so many characters


def track_digits(name: Column) -> Column:
    """First run of digits in the base name, extension included; null without one."""
    digits = ascii_digits(F.regexp_extract(file_name(name), rf"({DIGIT}+)", 1))
    return F.nullif(digits, F.lit(""))


def _order_columns() -> dict[str, Column]:
    """Numbers of any length compare by length, then digit by digit; none comes last."""
    significant = F.regexp_replace(track_digits(F.col("file_name")), r"\A0+(?=.)", "")
    return {
        "_missing": significant.isNull(),
        "_length": F.length(significant),
        "_digits": significant,
    }


_ORDER = ["_missing", "_length", "_digits", "file_name"]
_BLOCK = ["_missing", "_length", "_lead"]


def _lead() -> Column:
    """What tracks of a block share, in order: a number's digits but the last few, or the
    beginning of a name without one."""
    leading = F.left("_digits", F.greatest(F.lit(0), F.col("_length") - BLOCK_DIGITS))
    return F.coalesce(leading, F.left("file_name", F.lit(NAME_CHARS)))


def track_timeline(tracks: DataFrame, gap_ms: int = GAP_MS, key: str = "album_id") -> DataFrame:
    """Tracks in order: digits, number, position (1-based) and start_ms in the merged track.

    digits is the number without leading zeros, of any length; number is the same as a bigint,
    null beyond 18 digits. An album is cut into blocks of its order, of at most
    10^BLOCK_DIGITS different numbers; what lies before a block is a running total over one
    small row for each. A plan without a job of its own, alike at every size.
    """
    keyed = tracks.select(key, "file_name", "duration_ms").withColumns(_order_columns())
    keyed = keyed.withColumn("_lead", _lead())
    step = F.col("duration_ms") + gap_ms
    # Null numbers and keys are blocks and albums like any other, so joins are null-safe.
    chain = Window.partitionBy(key).orderBy(*_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = keyed.groupBy(key, *_BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.sum(step).alias("_ms"))
    blocks = blocks.select(
        *[F.col(c).alias(f"_b{c}") for c in (key, *_BLOCK)],
        F.sum("_n").over(chain).alias("_earlier"), F.sum("_ms").over(chain).alias("_since"),
    ).filter(F.col("_earlier") > 0)
    same = [keyed[c].eqNullSafe(blocks[f"_b{c}"]) for c in (key, *_BLOCK)]
    joined = keyed.join(blocks, same, "left")
    inside = Window.partitionBy(key, *_BLOCK).orderBy(*_ORDER)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return joined.select(
        key,
        "file_name",
        F.col("_digits").alias("digits"),
        F.col("_digits").try_cast("bigint").alias("number"),
        (F.row_number().over(inside) + F.coalesce("_earlier", zero)).cast("bigint").alias("position"),
        "duration_ms",
        (F.coalesce(F.sum(step).over(before), zero) + F.coalesce("_since", zero)).cast("bigint").alias("start_ms"),
    )


def track_order(tracks: DataFrame, key: str = "album_id") -> DataFrame:
    """Tracks with their number and place in the album."""
    return track_timeline(tracks, 0, key).select(key, "file_name", "digits", "number", "position")


def album_length(tracks: DataFrame, gap_ms: int = GAP_MS, key: str = "album_id") -> DataFrame:
    """Length of the merged track; an album without tracks has no row."""
    count = F.count(F.lit(1))
    return tracks.groupBy(key).agg(
        count.cast("bigint").alias("tracks"),
        (F.sum("duration_ms") + (count - 1) * gap_ms).cast("bigint").alias("total_ms"),
    )
