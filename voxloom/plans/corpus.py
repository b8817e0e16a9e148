"""Raw documents or pages -> synthesis requests -> outcomes -> the merged track."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.manifest import VOICE, batch_outcomes, output_files, synthesis_manifest
from voxloom.operators.normalize import normalize, raw_line_count
from voxloom.operators.pages import MAX_PAGES, pages_of_chunks, utterances_from_pages
from voxloom.operators.sentences import utterances
from voxloom.operators.timeline import GAP_MS, track_timeline
from voxloom.plans.counts import StageCounts, unwatched


def prepare_corpus(
    docs: DataFrame,
    sentences_per_utterance: int = 1,
    prefix: str = "sentence",
    voice: str = VOICE,
    key: str = "doc_id",
    text: str = "text",
    rate: int = 0,
    pitch: int = 0,
    volume: int = 0,
    generate_subtitles: bool = False,
    counts: StageCounts | None = None,
) -> DataFrame:
    """Documents -> normalised text -> utterances -> requests, without a shuffle.

    counts, if given, has the documents and their raw lines, the kept paragraphs, the
    utterances, and the requests and those that cannot be made, when the result was written.
    """
    watch = counts.watch if counts else unwatched
    docs = watch(docs, "documents", raw_lines=raw_line_count(F.col(text)))
    kept = F.size(F.array_remove(F.split("text", "\n\n", -1), ""))
    normalised = watch(normalize(docs, key, text), "normalised", paragraphs=kept)
    made = watch(utterances(normalised, sentences_per_utterance, prefix, key), "utterances")
    requests = synthesis_manifest(made, voice, rate, pitch, volume, generate_subtitles, key)
    return watch(requests, "requests", failed=F.col("error").isNotNull().cast("int"))


def prepare_corpus_from_pages(
    pages: DataFrame,
    sentences_per_utterance: int = 1,
    prefix: str = "sentence",
    voice: str = VOICE,
    key: str = "doc_id",
    page_no: str = "page_no",
    text: str = "text",
    max_pages: int = MAX_PAGES,
    rate: int = 0,
    pitch: int = 0,
    volume: int = 0,
    generate_subtitles: bool = False,
    is_long: str | None = None,
) -> DataFrame:
    """Pages -> documents -> normalised text -> utterances -> requests."""
    made = utterances_from_pages(
        pages, sentences_per_utterance, prefix, key, page_no, text, max_pages, is_long
    )
    return synthesis_manifest(made, voice, rate, pitch, volume, generate_subtitles, key)


def prepare_corpus_from_chunks(
    chunks: DataFrame, chunk_no: str = "chunk_no", key: str = "doc_id", text: str = "text", max_pages: int = MAX_PAGES, **options
) -> DataFrame:
    """Texts in chunks (sources.files.read_chunks, or cut anywhere) -> requests.

    A text of more than max_pages pages is never put together: one of any size is the work of
    many tasks. options are those of prepare_corpus_from_pages.
    """
    pages = pages_of_chunks(chunks, key, chunk_no, text, max_pages=max_pages)
    return prepare_corpus_from_pages(pages, key=key, text=text, max_pages=max_pages, is_long="is_long", **options)


def merged_track(
    requests: DataFrame, reported: DataFrame, lengths: DataFrame, gap_ms: int = GAP_MS, key: str = "doc_id"
) -> DataFrame:
    """The batch's end: every document's audio files in the order of their numbers, with where
    each one begins in the merged track.

    reported is that of batch_outcomes; lengths has path and duration_ms of audio files. Only
    files that the batch wrote are merged; one without a known length is left out, as a file
    that is not there would be.
    """
    written = output_files(batch_outcomes(requests, reported, key), key).filter(F.col("place") == 0)
    tracks = written.select(key, F.col("path").alias("file_name"))
    known = lengths.select(F.col("path").alias("file_name"), "duration_ms")
    return track_timeline(tracks.join(known, "file_name"), gap_ms, key)
