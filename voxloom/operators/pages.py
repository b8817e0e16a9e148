"""Page rows -> document text, and page rows -> utterances.

Ordinary documents are assembled with one shuffle and then handled in their row.
A document with very many pages is never put together: its lines, paragraphs and
sentences are numbered by running totals and grouped each by its own number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.text import strip
from voxloom.operators.blocks import position_block, running_totals, scope, settle, split_long_groups
from voxloom.operators.normalize import clean_text, is_speakable, normalize, paragraph_text
from voxloom.operators.sentences import (
    SENTENCE_END,
    check_group_size,
    join_sentences,
    utterance_name,
    utterances,
)

# A document with more pages than this does not become one row.
MAX_PAGES = 4096


def _in_order(position: str, value: str) -> Column:
    """Aggregate: the values of a group as an array, by position."""
    rows = F.sort_array(F.collect_list(F.struct(position, value)))
    return rows.getField(value)


def assemble_pages(
    pages: DataFrame,
    key: str = "doc_id",
    page_no: str = "page_no",
    text: str = "text",
    pages_per_part: int = MAX_PAGES,
) -> DataFrame:
    """Document text, each page followed by a line feed; a page without text is empty.

    A document longer than pages_per_part pages comes as several parts; the parts
    in order are its text. No group holds more pages than that.
    """
    part = position_block(page_no, pages_per_part)
    page_text = F.coalesce(F.col(text), F.lit(""))
    rows = pages.select(key, part.alias("part_no"), F.col(page_no).alias("_page"), page_text.alias(text))
    joined = F.concat(F.array_join(_in_order("_page", text), "\n"), F.lit("\n"))
    return rows.groupBy(key, "part_no").agg(joined.alias(text))


def pages_of_chunks(
    chunks: DataFrame,
    key: str = "doc_id",
    chunk_no: str = "chunk_no",
    text: str = "text",
    block_rows: int = MAX_PAGES,
    max_pages: int | None = None,
) -> DataFrame:
    """Chunks of a text, cut anywhere, as pages (key, page_no, text) that end where lines end.

    What stands before a chunk's first line feed belongs to the page of the chunk before it, so
    a chunk passes on its beginning, and one without a line feed all of itself. A page's number
    is that of the line feeds' chunks before it, a running total, so a text of any number of
    chunks is spread over tasks; a page holds about one chunk, or one line if that is longer.
    Null chunks are empty. Pages joined by line feeds are the text. With max_pages, is_long tells
    the pages of texts that have more of them.

    Texts are shuffled once, by their blocks of chunks, and pages are put together there and
    settled; only those of texts of several blocks meet again. Line feeds are counted in a reading
    of the chunks of its own.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = chunks.select(key, F.col(chunk_no).alias("_chunk"), body.alias("_body"), F.instr(body, "\n").alias("_feed"))
    rows = rows.withColumn("_block", position_block("_chunk", block_rows))
    has_feed = F.when(F.col("_feed") > 0, 1).otherwise(0)

    per_block = rows.groupBy(key, "_block").agg(F.sum(has_feed).alias("_feeds"))
    all_blocks = Window.partitionBy(key)
    earlier = all_blocks.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    several = per_block.select(
        key, "_block", F.sum("_feeds").over(earlier).alias("_carry"), F.sum("_feeds").over(all_blocks).alias("_total"),
        F.count(F.lit(1)).over(all_blocks).alias("_blocks"),
    ).filter(F.col("_blocks") > 1)

    block = Window.partitionBy(key, "_block")
    before = F.sum(has_feed).over(block.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))
    feeds = F.coalesce("_total", F.sum(has_feed).over(block))
    numbered = rows.join(several, [key, "_block"], "left").withColumns(
        {
            "_page": F.coalesce("_carry", F.lit(0)) + F.coalesce(before, F.lit(0)),
            "_shared": F.col("_blocks").isNotNull(),
            "is_long": (feeds >= max_pages) & F.col(key).isNotNull() if max_pages is not None else F.lit(False),
        }
    )
    head = F.when(F.col("_feed") > 0, F.left("_body", F.col("_feed"))).otherwise(F.col("_body"))
    rest = F.substring("_body", F.col("_feed") + 1, F.length("_body"))

    def piece(page: Column, part: int, value: Column) -> Column:
        return F.struct(page.cast("bigint").alias("page_no"), F.lit(part).alias("part"), value.alias("piece"))

    first, second = piece(F.col("_page"), 0, head), piece(F.col("_page") + 1, 1, rest)
    both = F.when(F.col("_feed") > 0, F.array(first, second)).otherwise(F.array(first))
    names = [key, "_block", "_shared", "is_long"]
    pieces = numbered.select(*names, "_chunk", F.explode(both).alias("p")).select(*names, "_chunk", "p.*")
    in_order = F.sort_array(F.collect_list(F.struct("_chunk", "part", "piece"))).getField("piece")
    parts = settle(
        pieces.groupBy(key, "_block", "page_no").agg(
            F.array_join(in_order, "").alias("_all"), F.first("_shared").alias("_shared"), F.first("is_long").alias("is_long")
        )
    )
    shared = parts.filter("_shared").groupBy(key, "page_no").agg(
        F.array_join(_in_order("_block", "_all"), "").alias("_all"), F.first("is_long").alias("is_long")
    )
    whole = parts.filter("not _shared").select(key, "page_no", "_all", "is_long").unionByName(shared)
    flag = ["is_long"] if max_pages is not None else []
    return whole.select(key, "page_no", F.regexp_replace("_all", r"\n\z", "").alias(text), *flag)


def utterances_from_pages(
    pages: DataFrame,
    sentences_per_utterance: int = 1,
    prefix: str = "sentence",
    key: str = "doc_id",
    page_no: str = "page_no",
    text: str = "text",
    max_pages: int = MAX_PAGES,
    is_long: str | None = None,
) -> DataFrame:
    """Pages -> text -> normalised text -> utterances.

    is_long names a column that tells the pages of texts with more than max_pages; without one,
    these texts are looked for and their pages told by a join.
    """
    check_group_size(sentences_per_utterance)
    if is_long is None:
        ordinary, long = split_long_groups(pages, key, max_pages, page_no)
    else:
        ordinary, long = pages.filter(~F.col(is_long)), pages.filter(is_long)
        long = None if long.isEmpty() else long
    docs = assemble_pages(ordinary, key, page_no, text, max_pages)
    result = utterances(normalize(docs, key, text), sentences_per_utterance, prefix, key, "text")
    if long is None:
        return result
    return result.unionByName(
        long_utterances(long, sentences_per_utterance, prefix, key, page_no, text, max_pages)
    )


def long_paragraphs(
    pages: DataFrame,
    key: str = "doc_id",
    page_no: str = "page_no",
    text: str = "text",
    block_rows: int = MAX_PAGES,
) -> DataFrame:
    """Kept paragraphs (key, para_no, para) without assembling the document.

    A line never runs over a page end, so a page is cleaned alone. Its pieces of
    paragraphs are all closed but perhaps the last, so a piece's paragraph number
    is the number of closed pieces on earlier pages plus its place on the page.
    """
    cleaned = pages.select(key, page_no, paragraph_text(clean_text(F.col(text))).alias("body"))
    # Settled before the filter, which would otherwise clean each page a second time.
    cleaned = settle(cleaned).filter(F.col("body") != "")
    numbered = running_totals(
        cleaned.withColumn("_block", position_block(page_no, block_rows)),
        key,
        [page_no],
        {"first_no": F.regexp_count("body", F.lit(r"[.!?)](?:\n|\z)"))},
    )
    pieces = numbered.select(
        key, page_no, "first_no", F.posexplode(F.split("body", "\n", -1)).alias("place", "piece")
    )
    joined = pieces.groupBy(key, (F.col("first_no") + F.col("place")).alias("para_no")).agg(
        F.array_join(_in_order(page_no, "piece"), " ").alias("para")
    )
    return joined.filter(is_speakable(F.col("para")))


def long_utterances(
    pages: DataFrame,
    sentences_per_utterance: int = 1,
    prefix: str = "sentence",
    key: str = "doc_id",
    page_no: str = "page_no",
    text: str = "text",
    block_rows: int = MAX_PAGES,
) -> DataFrame:
    """Utterances without assembling the document; equal to the row-local form.

    Each paragraph is split alone. Its last piece goes on in the next paragraph, so
    a piece's sentence number is the number of splits before it. Tables in between are removed
    when the next is there.
    """
    with scope(pages.sparkSession) as keep:
        kept = keep(_long_sentences(pages, key, page_no, text, block_rows))
    counted = running_totals(
        kept.withColumn("_block", position_block("raw_no", block_rows)),
        key,
        ["raw_no"],
        {"n": F.lit(1)},
    )
    number = (position_block("n", sentences_per_utterance) + 1).cast("int")
    grouped = counted.groupBy(key, number.alias("utt_no")).agg(
        join_sentences(_in_order("n", "sentence")).alias("content")
    )
    return grouped.select(
        key, "utt_no", utterance_name(F.col("utt_no"), prefix).alias("utt_name"), "content"
    )


def _long_sentences(pages: DataFrame, key: str, page_no: str, text: str, block_rows: int) -> DataFrame:
    """Sentences (key, raw_no, sentence) with the numbers that they have before empty ones go."""
    with scope(pages.sparkSession) as keep:
        paras = keep(long_paragraphs(pages, key, page_no, text, block_rows))
    paras = paras.select(key, "para_no", F.split("para", SENTENCE_END, -1).alias("pieces"))
    numbered = running_totals(
        paras.withColumn("_block", position_block("para_no", block_rows)),
        key,
        ["para_no"],
        {"first_no": F.size("pieces") - 1},
    )
    pieces = numbered.select(
        key, "para_no", "first_no", F.posexplode("pieces").alias("place", "piece")
    )
    raw = pieces.groupBy(key, (F.col("first_no") + F.col("place")).alias("raw_no")).agg(
        F.array_join(_in_order("para_no", "piece"), "\n\n").alias("joined")
    )
    raw = raw.select(key, "raw_no", strip(F.col("joined")).alias("sentence"))
    return raw.filter(F.col("sentence") != "")
