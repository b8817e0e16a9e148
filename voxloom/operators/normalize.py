"""Raw text -> cleaned lines -> paragraphs -> normalised text.

All of it is row-local: a document (or a page) is cleaned by a fixed sequence
of regular expressions over its whole text, so there is no shuffle, the plan
is the same on a stream, and copies or hot sources cost nothing extra.

The whole-text form keeps every line between two line feeds: the text starts
and ends with one, and a rule about "the line" is a pattern between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import DIGIT, WORD, WS, sub, universal_newlines

# Which whole lines are dropped, after stripping.
DROP_PATTERNS = {
    "page_number": rf"\n{DIGIT}{{1,3}}(?=\n)",
    "chapter_header": rf"\nChapter {DIGIT}+:(?=\n)",
    "separator": r"\n[_\-=]{3,}(?=\n)",
}

# What is edited inside a line, in this order.
EDIT_RULES = {
    "bullet": sub(r"\n[•\-*][ \t]*+", "\n"),
    "numbering": sub(r"\n[A-Z0-9]++\.[ \t]*+", "\n"),
    # An unclosed bracket is matched with the rest of its line and put back: one scan.
    "brackets": sub(r"\[[^\]\n]*+\]|(\[[^\]\n]*+)(?=\n)", "$1"),
    "handles": sub(rf"@[{WORD}]+", ""),
    "urls": sub(r"https?://[^ \t\n]+", ""),
    "ampersand": lambda c: F.replace(c, F.lit("&"), F.lit(" and ")),
    "greater_than": lambda c: F.replace(c, F.lit(">"), F.lit(" greater than ")),
    "less_than": lambda c: F.replace(c, F.lit("<"), F.lit(" less than ")),
    "arrow": lambda c: F.replace(c, F.lit("->"), F.lit(" leads to ")),
    "positive": sub(r"\+[ \t]*ve", "positive"),
    "negative": sub(r"-[ \t]*ve", "negative"),
    "collapse": lambda c: sub(r" \n ?|\n ", "\n")(sub(r"[ \t][ \t]++|\t", " ")(c)),
}

# Which paragraphs are dropped.
MIN_PARAGRAPH_CHARS = 10
BOILERPLATE = ("Copyright", "All Rights Reserved")

# A line feed that does not follow sentence-ending punctuation joins two lines.
_INSIDE_PARAGRAPH = r"\n(?<![.!?)]\n)"
_BLANK_LINES = r"\n\n++"


def framed_lines(text: Column) -> Column:
    """Text between two line feeds, line ends unified.

    All white space within a line except the blank becomes a tab. No rule tells
    such characters apart, and a two-member class keeps the later patterns fast.
    """
    folded = F.regexp_replace(universal_newlines(text), rf"[{WS}&&[^ \t\n]]", "\t")
    return F.concat(F.lit("\n"), folded, F.lit("\n"))


def strip_lines(framed: Column) -> Column:
    """Strip each line and drop the empty ones."""
    right = F.regexp_replace(framed, r"[ \t](?<![ \t][ \t])[ \t]*+(?=\n)", "")
    return F.regexp_replace(right, r"\n[ \t\n]++", "\n")


def drop_lines(stripped: Column) -> Column:
    """Drop page numbers, bare chapter headers and separators."""
    bodies = "|".join(p.removeprefix(r"\n").removesuffix(r"(?=\n)") for p in DROP_PATTERNS.values())
    return F.regexp_replace(stripped, rf"\n(?:{bodies})(?=\n)", "")


def edit_lines(kept: Column) -> Column:
    """Apply the edit rules in order and drop the lines they emptied."""
    for rule in EDIT_RULES.values():
        kept = rule(kept)
    return F.regexp_replace(kept, _BLANK_LINES, "\n")


def clean_text(text: Column) -> Column:
    """Cleaned lines joined by one line feed, without a frame."""
    return F.btrim(edit_lines(drop_lines(strip_lines(framed_lines(text)))), F.lit("\n"))


def paragraph_text(cleaned: Column) -> Column:
    """Cleaned lines as paragraphs, one per line, none dropped yet."""
    return F.regexp_replace(cleaned, _INSIDE_PARAGRAPH, " ")


def is_speakable(paragraph: Column) -> Column:
    """False for short and for boilerplate paragraphs."""
    keep = F.length(paragraph) >= MIN_PARAGRAPH_CHARS
    for phrase in BOILERPLATE:
        keep = keep & ~F.contains(paragraph, F.lit(phrase))
    return keep


def raw_line_count(text: Column) -> Column:
    """Number of lines before any rule."""
    return F.size(F.split(universal_newlines(text), "\n", -1))


def _members(joined: Column) -> Column:
    """Array of the non-empty lines of a text."""
    return F.array_remove(F.split(joined, "\n", -1), "")


def clean_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per cleaned line: key, pos (0-based), line."""
    return docs.select(key, F.posexplode(_members(clean_text(F.col(text)))).alias("pos", "line"))


def paragraph_ids(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cleaned lines with the number of the paragraph each one belongs to."""
    closed = F.regexp_replace(clean_text(F.col(text)), r"(?<=[.!?)])\n", "\n\n")
    groups = docs.select(key, F.posexplode(F.split(closed, "\n\n", -1)).alias("para_no", "body"))
    lines = groups.filter(F.col("body") != "").select(
        key, "para_no", F.posexplode(F.split("body", "\n", -1)).alias("line_no", "line")
    )
    return lines


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Kept paragraphs; para_no counts the dropped ones too."""
    joined = paragraph_text(clean_text(F.col(text)))
    rows = docs.select(key, F.posexplode(_members(joined)).alias("para_no", "para"))
    return rows.filter(is_speakable(F.col("para")))


def normalize(
    docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "text"
) -> DataFrame:
    """One row per document: kept paragraphs joined by a blank line.

    The paragraph filter uses its input more than once, so the projection below
    it stays a step of its own and the rules run once per document.
    """
    # Paragraphs shorter than the minimum are a line pattern like the others.
    framed = F.concat(F.lit("\n"), paragraph_text(clean_text(F.col(text))), F.lit("\n"))
    short = rf"\n[^\n]{{0,{MIN_PARAGRAPH_CHARS - 1}}}(?=\n)"
    staged = docs.select(key, F.regexp_replace(framed, short, "").alias(out))

    body = F.col(out)
    suspect = F.lit(False)
    for phrase in BOILERPLATE:
        suspect = suspect | F.contains(body, F.lit(phrase))
    boiler = rf"\n[^\n]*?(?:{'|'.join(BOILERPLATE)})[^\n]*+(?=\n)"
    filtered = F.when(suspect, F.regexp_replace(body, boiler, "")).otherwise(body)
    return staged.select(
        key, F.replace(F.btrim(filtered, F.lit("\n")), F.lit("\n"), F.lit("\n\n")).alias(out)
    )


def normalize_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Raw line count and kept paragraph count per document."""
    counted = docs.select(key, raw_line_count(F.col(text)).alias("raw_lines"), text)
    done = normalize(
        counted.select(F.struct(key, "raw_lines").alias("id"), text), key="id", text=text
    )
    return done.select(
        f"id.{key}",
        F.col("id.raw_lines").cast("bigint").alias("raw_lines"),
        F.size(F.array_remove(F.split("text", "\n\n", -1), "")).cast("bigint").alias("paragraphs"),
    )


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document, how many lines each dropping rule removed.

    Counted inside the row from the text before and after each step.
    """
    def lines(c: str) -> Column:
        return F.size(F.array_remove(F.split(c, "\n", -1), ""))

    staged = docs.select(
        key,
        raw_line_count(F.col(text)).alias("raw_lines"),
        strip_lines(framed_lines(F.col(text))).alias("stripped"),
    )
    counted = staged.select(
        key,
        "raw_lines",
        lines("stripped").alias("non_empty"),
        *[F.regexp_count("stripped", F.lit(p)).alias(n) for n, p in DROP_PATTERNS.items()],
        edit_lines(drop_lines(F.col("stripped"))).alias("edited"),
    )
    dropped = sum((F.col(n) for n in DROP_PATTERNS), F.lit(0))
    return counted.select(
        key,
        (F.col("raw_lines") - F.col("non_empty")).cast("bigint").alias("empty"),
        *[F.col(n).cast("bigint").alias(n) for n in DROP_PATTERNS],
        (F.col("non_empty") - dropped - lines("edited")).cast("bigint").alias("emptied"),
    )


def rule_hits(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per edit rule, how many lines it changed.

    The counts are summed on the map side; one row per task is shuffled.
    """
    kept = drop_lines(strip_lines(framed_lines(F.col(text))))
    stage = docs.select(F.explode(_members(kept)).alias("line"))
    stage = stage.select(F.concat(F.lit("\n"), "line", F.lit("\n")).alias("now"))
    counters: list[str] = []
    for name, rule in EDIT_RULES.items():
        stage = stage.select(*counters, F.col("now").alias("before"), rule(F.col("now")).alias("now"))
        changed = (F.col("before") != F.col("now")).cast("bigint").alias(name)
        stage = stage.select(*counters, changed, "now")
        counters.append(name)
    totals = stage.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counters])
    return totals.unpivot([], counters, "rule", "lines")
