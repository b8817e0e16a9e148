"""Small hand-made rows that hit every rule; queries add them to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

F1_LINES = [
    "  Chapter 12:  ",
    "Chapter 1: The Start",
    "42",
    "1234",
    "௧௨",
    "-----",
    "=_-",
    "--",
    "• First point is here.",
    "- ve charge and + ve charge",
    "* * starred",
    "1. Numbered item",
    "NASA. launched a probe",
    "3.14 is pi.",
    "[NEW] text [x] stays.",
    "[only]",
    "mail me@site.org or @user_1 now.",
    "see https://a.b/c?d=e. Next",
    "a->b & c<d!",
    "->start",
    "the gas is -very cold (ok)",
    "\ttabs\u00a0and\u3000wide   spaces\t",
    "end?",
    "Tiny.",
    "Copyright 2020 Foo. All Rights Reserved.",
    "Dr. Smith paid 3.50 dollars. Wait... what",
    'he said "stop."',
    "no terminator at the tail",
]

F1 = [(900001, "\r\n".join(F1_LINES)), (900002, "   \n\n12\n"), (900003, "")]
F1_SCHEMA = "doc_id bigint, text string"

F2 = [
    (
        900001,
        "a.srt",
        "1\n00:00:01,000 --> 00:00:02,500\nHello\nworld\n\n2\n00:00:03,000-->00:00:04,000\n\n"
        "noise\n3\nnot a time\n4\n01:00:00,005 --> 01:00:01,000 X1\n5\n\n",
    ),
    (900002, "b.txt", "1\n\n00:00:01,000 --> 00:00:02,000\nhi"),
    (900003, "c.srt", "just prose"),
    (
        900004,
        "d.srt",
        "\ufeff1\n00:00:01,000 --> 00:00:02,000\nx\n\n2\n00:00:05,000 --> 00:00:06,000\ny",
    ),
]
F2_SCHEMA = "doc_id bigint, file_name string, content string"

F3 = [(0.0, "00:00:00,000"), (1234.9, "00:00:01,234"), (3600005.0, "01:00:00,005"),
      (360000000.0, "100:00:00,000")]
F3_SCHEMA = "ms double, txt string"

F4_WORDS = ["Hello", ",", "one", "two", "three", "four", "five", "six", "seven", "eight"]
F4_OFFSETS = [0, 200, 300, 400, 500, 600, 700, 1100, 1501, 1901]
F4_DURATIONS = [200, 50, 100, 100, 100, 100, 100, 100, 100, 100]
F4 = [
    ("f4", i, word, offset * 10000, duration * 10000, i == len(F4_WORDS) - 1)
    for i, (word, offset, duration) in enumerate(zip(F4_WORDS, F4_OFFSETS, F4_DURATIONS))
]
F4_SCHEMA = (
    "utt_id string, seq int, word string, offset_ticks bigint, duration_ticks bigint, "
    "is_last boolean"
)

F5_FILES = [
    (1, "u_0001.txt", "mp3/u_0001.mp3", "mp3/u_0001.srt", None),
    (2, "u_0002.txt", None, None, "Please enter text to convert."),
    (3, "u_0003.txt", "mp3/u_0003.mp3", None, None),
]

F6 = [
    (900001, "sentence_0001.mp3", 1000),
    (900001, "sentence_0002.mp3", 1500),
    (900001, "merged.mp3", 9000),
    (900001, "sentence_0010.mp3", 700),
    (900001, "intro", 10),
    (900002, "b_99999999999999999999999.mp3", 5),
    (900002, "a_100000000000000000000000.mp3", 6),
    (900002, "t_௧௨.mp3", 7),
    (900002, "t_0012.mp3", 8),
]
F6_SCHEMA = "album_id bigint, file_name string, duration_ms bigint"

PATHS = [
    "a/b/c.txt", "c.tar.gz", "x/.srt", "UP.SRT", "..srt", "a..srt", "no_extension", "dir.d/file",
    "end.", "x/.hidden.txt", "",
]


def frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def sql_text(value: str | None) -> str:
    """A SQL string expression; control and non-ASCII characters by code point."""
    if value is None:
        return "NULL"
    parts, plain = [], ""
    for ch in value:
        if 32 <= ord(ch) < 127:
            plain += ch.replace("'", "''")
            continue
        if plain:
            parts.append(f"'{plain}'")
            plain = ""
        parts.append(f"chr({ord(ch)})")
    if plain or not parts:
        parts.append(f"'{plain}'")
    return "(" + " || ".join(parts) + ")"


def sql_values(rows: list[tuple], columns: str) -> str:
    """Rows as an inline SQL table."""
    def literal(v: object) -> str:
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        if isinstance(v, int):
            return str(v)
        return sql_text(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({columns}))"
