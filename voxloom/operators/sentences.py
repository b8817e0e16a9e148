"""Text -> sentences -> utterances of N sentences with stable names. Row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import WS, strip, zero_padded

# A period ends a sentence if white space or the end of the text follows. The
# white space on both sides of it belongs to the separator. "!" and "?" do not
# split, so a sentence may run over several paragraphs.
SENTENCE_END = (
    rf"\.(?:[{WS}]++|\z)|[{WS}](?<![{WS}][{WS}])[{WS}]*+\.(?:[{WS}]++|\z)"
)


def sentence_array(text: Column) -> Column:
    """Stripped, non-empty sentences in order, periods removed."""
    return F.array_remove(F.split(strip(text), SENTENCE_END, -1), "")


def join_sentences(group: Column) -> Column:
    """Sentences as one utterance text, each closed by a period."""
    return F.concat(F.array_join(group, ". "), F.lit("."))


def utterance_name(number: Column, prefix: str, suffix: str = ".txt") -> Column:
    """``prefix_0001.txt``; the number grows past four digits uncut."""
    return F.concat(F.lit(f"{prefix}_"), zero_padded(number, 4), F.lit(suffix))


def check_group_size(sentences_per_utterance: int) -> None:
    if sentences_per_utterance < 1:
        raise ValueError("sentences_per_utterance must be at least 1")


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per sentence: key, n (0-based), sentence."""
    return docs.select(key, F.posexplode(sentence_array(F.col(text))).alias("n", "sentence"))


def utterances(
    docs: DataFrame,
    sentences_per_utterance: int = 1,
    prefix: str = "sentence",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per utterance: key, utt_no (1-based), utt_name, content."""
    check_group_size(sentences_per_utterance)
    size = sentences_per_utterance
    if size == 1:
        rows = docs.select(key, F.posexplode(sentence_array(F.col(text))).alias("n", "sentence"))
        rows = rows.select(key, "n", F.concat("sentence", F.lit(".")).alias("content"))
    else:
        # The array is used several times below; a generator keeps it computed once.
        listed = docs.select(key, F.explode(F.array(sentence_array(F.col(text)))).alias("s"))
        starts = F.filter(
            F.sequence(F.lit(0), F.size("s"), F.lit(size)), lambda i: i < F.size("s")
        )
        groups = F.transform(starts, lambda i: join_sentences(F.slice("s", i + 1, F.lit(size))))
        rows = listed.select(key, F.posexplode(groups).alias("n", "content"))
    number = F.col("n") + 1
    return rows.select(
        key, number.alias("utt_no"), utterance_name(number, prefix).alias("utt_name"), "content"
    )


def utterance_counts(
    docs: DataFrame, sentences_per_utterance: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Number of utterances per document, zero included."""
    check_group_size(sentences_per_utterance)
    size = F.size(sentence_array(F.col(text)))
    count = F.ceil(size / F.lit(sentences_per_utterance))
    return docs.select(key, count.cast("bigint").alias("utterances"))
