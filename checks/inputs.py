"""Inputs that the queries derive from the given tables, in Spark and in SQL.

The tables hold none of the things most text rules look for. So line breaks
inside documents get noise lines from a fixed list, picked by document id; subtitle
files, word events, tracks and outcomes are derived from texts and conversations.
All rows of the tables are used.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from voxloom.functions.timecode import ms_to_timecode
from voxloom.operators.blocks import shared_dir
from voxloom.sources.files import write_text_files
from voxloom.sources.tables import read_table

# One noise text per remainder of the document id.
NOISE = [
    "12\nChapter 7:",
    "Chapter 7: not bare\n-----",
    "• A bullet item\n• • two",
    "1. Numbered item, then 2. more",
    "[NOTE] in brackets [x",
    "mail me@site.org now or @தமிழ்.",
    "see https://a.b/c?d=e. Next",
    "a->b & c<d > e",
    "+ ve and -\u00a0ve, -very",
    "Copyright 2020 Foo",
    "   spaced \t out   \n \t \n",
    "\u00a0\u3000wide\u2003gap\u2028line\u0085sep\u00a0",
    "cr\rcr\r\ncrlf",
    "tiny.",
    "NASA. launched\n=_=\n--\n௧௨\n1234",
    "All Rights Reserved.\n[gone]\n* . . a . b .",
]

WS_RE2 = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over more tasks, if the scan has fewer than cores: the small test tables are one
    row group each. keys name a row. Only the checks do this; the package keeps the scan's
    partitions, which spark.sql.files.maxPartitionBytes sizes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(4 * cores, *keys)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, f"{sf_dir}/documents.parquet", "doc_id", "text"), "doc_id")


def noisy(docs: DataFrame) -> DataFrame:
    """Documents with a noise text after each line that ends in a period, and at the end."""
    picked = F.element_at(
        F.array(*[F.lit(n) for n in NOISE]), (F.pmod("doc_id", F.lit(len(NOISE))) + 1).cast("int")
    )
    staged = docs.select("doc_id", "text", picked.alias("noise"))
    marked = F.replace(F.col("text"), F.lit(".\n"), F.concat(F.lit(".\n"), "noise", F.lit("\n")))
    return staged.select("doc_id", F.concat(marked, F.lit("\n"), "noise").alias("text"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisy(documents(spark, sf_dir)).unionByName(fx.frame(spark, fx.F1, fx.F1_SCHEMA))


def noisy_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN {fx.sql_text(n)}" for i, n in enumerate(NOISE))
    return f"""(
    SELECT doc_id, replace(text, '.' || chr(10), '.' || chr(10) || noise || chr(10))
           || chr(10) || noise AS text
    FROM (SELECT doc_id, text, CASE doc_id % {len(NOISE)} {cases} END AS noise FROM documents))"""


def texts_sql() -> str:
    return f"""(
    SELECT doc_id, text FROM {noisy_sql()}
    UNION ALL SELECT doc_id, text FROM {fx.sql_values(fx.F1, "doc_id, text")})"""


def whole_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as the pages of a document."""
    table = read_table(spark, f"{sf_dir}/conversations.parquet", "conv_id", "turn", "text")
    return spread(table, "conv_id", "turn").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text"
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, and a document of 5000 pages, more than a part holds; one page in seven has no text."""
    kept = F.when(F.pmod(F.col("doc_id") + F.col("page_no"), F.lit(7)) != 3, F.col("text"))
    number = F.col("id")
    line = F.concat(F.lit("Page "), number.cast("string"), F.lit(" ends."))
    long = spark.range(5000).select(F.lit(950001).cast("bigint").alias("doc_id"), number.alias("page_no"), line.alias("text"))
    return whole_pages(spark, sf_dir).unionByName(long).withColumn("text", kept)


PAGES_SQL = """(
    SELECT conv_id AS doc_id, turn AS page_no,
           CASE WHEN (conv_id + turn) % 7 <> 3 THEN text END AS text
    FROM conversations
    UNION ALL SELECT 950001, i, CASE WHEN (950001 + i) % 7 <> 3 THEN 'Page ' || i || ' ends.' END
    FROM range(5000) r(i))"""


def subtitle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a subtitle file: one cue per piece of text between periods.

    Pieces hold line breaks, and some blank lines, index lines and empty texts are
    mixed in. Every fifth document stays prose.
    """
    docs = documents(spark, sf_dir)

    def cue(piece: Column, i: Column) -> Column:
        start = i * 2000 + F.pmod(i, F.lit(7)) * 137
        end = start + 500 + F.length(piece) * 3
        body = F.when(F.pmod(i, F.lit(6)) == 4, F.lit("")).otherwise(piece)
        body = F.when(
            F.pmod(i, F.lit(9)) == 5, F.replace(body, F.lit(" "), F.lit("\n"))
        ).otherwise(body)
        gap = F.when(F.pmod(i, F.lit(11)) == 7, F.lit("\n3\n7\n")).otherwise(F.lit("\n\n"))
        return F.concat(
            (i + 1).cast("string"), F.lit("\n"), ms_to_timecode(start), F.lit(" --> "),
            ms_to_timecode(end), F.lit("\n"), body, gap,
        )

    made = F.array_join(F.transform(F.split("text", r"\. ", -1), cue), "")
    prose = F.pmod("doc_id", F.lit(5)) == 2
    name = F.concat(
        F.lit("doc_"),
        F.col("doc_id").cast("string"),
        F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit(".txt")).otherwise(F.lit(".SRT")),
    )
    content = F.when(prose, F.col("text")).otherwise(made)
    # The generator keeps the content computed once, however often it is used.
    files = docs.select(
        "doc_id", name.alias("file_name"), F.explode(F.array(content)).alias("content")
    )
    return files.unionByName(fx.frame(spark, fx.F2, fx.F2_SCHEMA))


def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a batch reads them: some could not be read, some are blank."""
    unread, blank = F.pmod("doc_id", F.lit(17)) == 3, F.pmod("doc_id", F.lit(13)) == 4
    content = F.when(unread, F.lit(None)).when(blank, F.lit("\n \u3000")).otherwise(F.col("content"))
    return subtitle_files(spark, sf_dir).select(
        "doc_id",
        F.col("file_name").alias("path"),
        content.alias("text"),
        F.when(unread, F.concat(F.lit("Failed to process file: "), "file_name")).alias("error"),
    )


def written_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Each document as a file of one folder, some hidden, some that no scan picks up; the
    folder, and doc_id, name, content."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    start = F.when(F.col("doc_id") % 4 == 1, "_").when(F.col("doc_id") % 4 == 2, ".").otherwise("")
    end = F.when(F.col("doc_id") % 3 == 0, ".srt").when(F.col("doc_id") % 3 == 1, ".txt").otherwise(".md")
    name = F.concat(start, F.col("doc_id").cast("string"), end)
    files = docs.select("doc_id", name.alias("name"), F.col("text").alias("content"))
    folder = f"{shared_dir(spark)}/files-{uuid4()}"
    write_text_files(files, folder, "content", "name")
    return folder, files


FILES_SQL = """(
    SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || doc_id
               || CASE doc_id % 3 WHEN 0 THEN '.srt' WHEN 1 THEN '.txt' ELSE '.md' END AS name,
           replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text
    FROM documents)"""


def sql_timecode(ms: str) -> str:
    ms = f"CAST(({ms}) AS BIGINT)"
    return (
        f"printf('%02d:%02d:%02d,%03d', {ms} // 3600000, ({ms} // 60000) % 60, "
        f"({ms} // 1000) % 60, {ms} % 1000)"
    )


def subtitle_files_sql() -> str:
    start = "(i * 2000 + (i % 7) * 137)"
    return f"""(
    SELECT doc_id,
           'doc_' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '.txt' ELSE '.SRT' END AS file_name,
           CASE WHEN doc_id % 5 = 2 THEN any_value(text)
                ELSE string_agg(cue, '' ORDER BY i) END AS content
    FROM (SELECT doc_id, text, i,
                 (i + 1) || chr(10) || {sql_timecode(start)} || ' --> '
                 || {sql_timecode(start + " + 500 + length(piece) * 3")} || chr(10)
                 || CASE WHEN i % 6 = 4 THEN ''
                         WHEN i % 9 = 5 THEN replace(piece, ' ', chr(10)) ELSE piece END
                 || CASE WHEN i % 11 = 7 THEN chr(10) || '3' || chr(10) || '7' || chr(10)
                         ELSE chr(10) || chr(10) END AS cue
          FROM (SELECT doc_id, text, unnest(string_split(text, '. ')) AS piece,
                       generate_subscripts(string_split(text, '. '), 1) - 1 AS i
                FROM documents))
    GROUP BY doc_id
    UNION ALL
    SELECT doc_id, file_name, content FROM {fx.sql_values(fx.F2, "doc_id, file_name, content")})"""


def events_of(docs: DataFrame) -> DataFrame:
    """Words of each document as timed events, with an audio chunk before some words."""
    listed = docs.select("doc_id", F.explode(F.array(F.split("text", r"[ \n]+", -1))).alias("words"))
    rows = listed.select(
        "doc_id", F.size("words").alias("n"), F.posexplode("words").alias("seq", "word")
    )
    pause = F.pmod(F.col("seq") * 7919 + F.col("doc_id"), F.lit(11)) * 40
    length = F.least(F.length("word"), F.lit(12)) * 25 + 100
    words = rows.select(
        F.col("doc_id").cast("string").alias("utt_id"),
        "seq",
        "word",
        ((F.col("seq").cast("bigint") * 420 + pause) * 10000).alias("offset_ticks"),
        (length.cast("bigint") * 10000).alias("duration_ticks"),
        (F.col("seq") == F.col("n") - 1).alias("is_last"),
    )
    types = F.when(
        F.pmod("seq", F.lit(4)) == 0, F.array(F.lit("audio"), F.lit("WordBoundary"))
    ).otherwise(F.array(F.lit("WordBoundary")))
    return words.select("*", F.explode(types).alias("type"))


def events_and_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = fx.frame(spark, fx.F4, fx.F4_SCHEMA).withColumn("type", F.lit("WordBoundary"))
    return events_of(documents(spark, sf_dir)).unionByName(extra).unionByName(_long_utterance(spark))


LONG_WORDS = 80_000  # more than a block of words, and more phrases than a part of subtitle text


def _long_utterance(spark: SparkSession) -> DataFrame:
    """Every eleventh word ends in a comma, and a pause follows each thousandth."""
    seq = F.col("id")
    return spark.range(LONG_WORDS).select(
        F.lit("long").alias("utt_id"),
        seq.cast("int").alias("seq"),
        F.when(seq % 11 == 5, "two,").otherwise("one").alias("word"),
        ((seq * 400 + F.expr("id div 1000") * 900) * 10000).alias("offset_ticks"),
        F.lit(4_000_000).cast("bigint").alias("duration_ticks"),
        (seq == LONG_WORDS - 1).alias("is_last"),
        F.lit("WordBoundary").alias("type"),
    )


def words_sql() -> str:
    return f"""(
    SELECT CAST(doc_id AS VARCHAR) AS utt_id, seq, word,
           (seq * 420 + ((seq * 7919 + doc_id) % 11) * 40) * 10000 AS offset_ticks,
           (least(length(word), 12) * 25 + 100) * 10000 AS duration_ticks
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS seq
          FROM (SELECT doc_id, regexp_split_to_array(text, '[ \\n]+') AS words FROM documents))
    UNION ALL
    SELECT 'long', i, CASE i % 11 WHEN 5 THEN 'two,' ELSE 'one' END, (i * 400 + i // 1000 * 900) * 10000, 4000000
    FROM range({LONG_WORDS}) r(i)
    UNION ALL
    SELECT utt_id, seq, word, offset_ticks, duration_ticks
    FROM {fx.sql_values(fx.F4, "utt_id, seq, word, offset_ticks, duration_ticks, is_last")})"""


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as the tracks of an album."""
    table = read_table(spark, f"{sf_dir}/conversations.parquet", "conv_id", "turn", "text")
    turns = spread(table, "conv_id", "turn")
    made = turns.select(
        F.col("conv_id").alias("album_id"),
        F.format_string("turn_%04d.mp3", "turn").alias("file_name"),
        (F.length("text").cast("bigint") * 60).alias("duration_ms"),
    )
    return made.unionByName(fx.frame(spark, fx.F6, fx.F6_SCHEMA))


def tracks_sql() -> str:
    return f"""(
    SELECT conv_id AS album_id, printf('turn_%04d.mp3', turn) AS file_name,
           length(text) * 60 AS duration_ms FROM conversations
    UNION ALL
    SELECT album_id, file_name, duration_ms
    FROM {fx.sql_values(fx.F6, "album_id, file_name, duration_ms")})"""
