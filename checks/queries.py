"""The Spark side: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import inputs
from voxloom.functions.timecode import ms_to_timecode, timecode_to_ms
from voxloom.operators import manifest as mf
from voxloom.operators.blocks import settle, shared_dir
from voxloom.operators import normalize as nz
from voxloom.operators import pages as pg
from voxloom.operators import phrases as ph
from voxloom.operators import sentences as st
from voxloom.operators import subtitles as sb
from voxloom.operators import timeline as tl
from voxloom.plans import batch as bt
from voxloom.plans.corpus import merged_track, prepare_corpus, prepare_corpus_from_chunks, prepare_corpus_from_pages
from voxloom.plans.counts import StageCounts
from voxloom.functions.paths import file_name
from voxloom.sources.files import decoded, read_listed, read_work_list, stream_directory, write_text_files
from voxloom.sources.tables import read_table
from voxloom.streaming.outcomes import stream_outcomes
from voxloom.streaming.phrase_batches import read_phrase_batches, write_phrase_batches
from voxloom.streaming.phrases import stream_phrases
from voxloom.streaming.runs import new_run, run_available
from voxloom.streaming.utterances import stream_utterances

Query = Callable[[SparkSession, str], DataFrame]


def _wide(df: DataFrame) -> DataFrame:
    """Integer columns as bigint, so both engines give the same schema."""
    return df.select(
        *[F.col(n).cast("bigint").alias(n) if t == "int" else F.col(n) for n, t in df.dtypes]
    )


def _on_texts(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _wide(operator(inputs.texts(spark, sf)))


def _on_files(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _wide(operator(inputs.subtitle_files(spark, sf)))


def _on_words(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _wide(
        operator(ph.word_events(inputs.events_and_fixture(spark, sf)))
    )


def _on_tracks(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _wide(operator(inputs.tracks(spark, sf)))


def _utterances(docs: DataFrame, size: int = 1) -> DataFrame:
    return st.utterances(nz.normalize(docs), size)


def _document_path() -> Column:
    return F.concat("lang", F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def work_list_union(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, f"{sf}/documents.parquet", "doc_id", "lang", "source")
    labels = read_table(spark, f"{sf}/labels.parquet", "doc_id").distinct()
    explicit = docs.join(labels, "doc_id", "left_semi").select(_document_path().alias("path"))
    return _wide(mf.work_list(explicit, docs.select(_document_path().alias("path"))))


def file_identity(spark: SparkSession, sf: str) -> DataFrame:
    urls = read_table(spark, f"{sf}/pages.parquet", "url").withColumnRenamed("url", "path")
    return mf.file_identity(
        urls.unionByName(fx.frame(spark, [(p,) for p in fx.PATHS], "path string"))
    )


def undecodable_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, f"{sf}/documents.parquet", "doc_id", "text", "lang", "source")
    broken = F.pmod("doc_id", F.lit(10)) == 3
    content = F.encode("text", "UTF-8")
    files = docs.select(
        _document_path().alias("path"),
        F.when(broken, F.concat(content, F.unhex(F.lit("FF41")))).otherwise(content).alias("content"),
    )
    return files.select("path", *decoded(F.col("content"), F.col("path")))


def work_files(spark: SparkSession, sf: str) -> DataFrame:
    """A list of files, one of them absent each time, then the folder: in order, with text or error."""
    folder, files = inputs.written_files(spark, sf)
    listed = files.filter(F.col("doc_id") % 100 == 0).orderBy("doc_id").select("name").collect()
    explicit = [f"{folder}/{name}" for row in listed for name in (row["name"], f"no {row['name']}")]
    rows = read_work_list(spark, explicit, folder)
    return _wide(rows.select("origin", "position", file_name(F.col("path")).alias("name"), "text", F.col("error").isNotNull().alias("failed")))


def work_files_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The folder as a stream, to its end."""
    folder, _ = inputs.written_files(spark, sf)
    stream = stream_directory(spark, folder, settle_ms=1)
    path = run_available(stream.select(file_name(F.col("path")).alias("name"), "text", "error"))
    return spark.read.schema("name string, text string, error string").parquet(path)


def exported_files(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances as files, a folder for each document, read back from a table of paths."""
    made = _utterances(inputs.texts(spark, sf))
    folder = f"{shared_dir(spark)}/export-{uuid4()}"
    write_text_files(made, folder, "content", "utt_name", "doc_id")
    path = F.concat_ws("/", F.lit(folder), F.col("doc_id").cast("string"), "utt_name")
    return _wide(read_listed(made.select("doc_id", "utt_no", "utt_name", path.alias("path"))).drop("path"))


def page_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(pg.assemble_pages(inputs.pages(spark, sf)))


def _times(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.col("utt_no").cast("bigint") * 100003 + F.pmod("doc_id", F.lit(1000))
    return _utterances(inputs.texts(spark, sf)).select("doc_id", "utt_no", ms.alias("ms"))


def srt_time_to_ms(spark: SparkSession, sf: str) -> DataFrame:
    times = _times(spark, sf)
    codes = times.select(ms_to_timecode(F.col("ms")).alias("code")).distinct()
    return codes.select("code", timecode_to_ms(F.col("code")).alias("ms"))


def ms_to_srt_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = _times(spark, sf).select("doc_id", "utt_no", F.col("ms").cast("double").alias("ms"))
    extra = fx.frame(spark, fx.F3, fx.F3_SCHEMA)
    zero = F.lit(0).cast("bigint")
    rows = rows.unionByName(extra.select(zero.alias("doc_id"), F.lit(0).alias("utt_no"), "ms"))
    return _wide(rows.withColumn("code", ms_to_timecode(F.col("ms"))))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    return mf.synthesis_manifest(_utterances(inputs.texts(spark, sf)))


def synthesis_manifest(spark: SparkSession, sf: str) -> DataFrame:
    made = _utterances(inputs.texts(spark, sf))
    return _wide(mf.synthesis_manifest(made, rate=5, pitch=-5, volume=10, generate_subtitles=True))


def manifest_errors(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("page_no") + 1
    blank = F.pmod(F.col("doc_id") + F.col("page_no"), F.lit(5)) == 0
    files = inputs.pages(spark, sf).select(
        "doc_id",
        number.alias("utt_no"),
        st.utterance_name(number, "page").alias("utt_name"),
        F.when(blank, F.lit("\n \u3000")).otherwise(F.coalesce("text", F.lit(""))).alias("content"),
    )
    return mf.manifest_errors(mf.synthesis_manifest(files))


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Requests joined with results reported for six in seven of them. Both sides read the
    requests' names from one settled table: the texts are normalised once."""
    columns = ("doc_id", "utt_no", "utt_id", "file", "audio_name", "error")
    requests = settle(_manifest(spark, sf).select(*columns))
    r = F.pmod(F.col("doc_id") * 31 + F.col("utt_no"), F.lit(7))
    audio = F.concat(F.lit("mp3/"), F.col("doc_id").cast("string"), F.lit("/"), "audio_name")
    reported = requests.filter(r > 0).select(
        "utt_id",
        F.when(r > 1, audio).alias("audio"),
        F.when((r > 1) & (r % 2 == 0), F.regexp_replace(audio, r"\.mp3$", ".srt")).alias("subtitle"),
        F.when(r == 1, F.lit("No audio was received.")).alias("error"),
    )
    return mf.batch_outcomes(requests, reported)


def _on_outcomes(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _wide(operator(_outcomes(spark, sf)))


def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and message of every document's batch, also of those without an utterance."""
    batches = settle(inputs.texts(spark, sf).select("doc_id"))
    return _wide(mf.batch_summary(_outcomes(spark, sf), batches=batches))


def _on_cue_outcomes(operator: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        files = inputs.subtitle_files(spark, sf)
        placement = sb.cue_placement(files)
        failed = F.pmod(F.col("doc_id") * 13 + F.col("cue_no"), F.lit(6)) == 1
        reported = placement.select(
            "doc_id", "cue_no", F.when(failed, F.lit("No audio was received.")).alias("error")
        )
        return _wide(operator(files, placement, reported))

    return run


def batch_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(bt.batch_requests(inputs.batch_files(spark, sf), rate=5, pitch=-5, key="doc_id"))


def _reports(requests: DataFrame) -> DataFrame:
    """Of six requests one fails, one is not reported, and one succeeds in a second attempt."""
    r = F.pmod(F.col("doc_id") * 13 + F.col("cue_no"), F.lit(6))
    bad, good = F.lit("No audio was received."), F.lit(None).cast("string")
    tries = F.when(r == 1, F.array(bad)).when(r == 2, F.array(bad, good)).otherwise(F.array(good))
    made = requests.filter((F.col("kind") != "error") & (r != 3))
    return made.select("doc_id", "cue_no", F.posexplode(tries).alias("attempt", "error"))


def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.batch_files(spark, sf)
    requests = bt.batch_requests(files, key="doc_id")
    return _wide(bt.batch_report(files, requests, _reports(requests), "mp3", generate_subtitles=True, key="doc_id"))


def batch_report_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same report; requests and reports come as streams, with times of their own, and a
    last row of each far ahead, so that the watermark passes all others. Its keys are not null,
    or the join would drop it before its time is seen."""
    files = inputs.batch_files(spark, sf)
    requests = bt.batch_requests(files, key="doc_id").select("doc_id", "cue_no", "kind", "error")
    second = 3600 + F.col("cue_no") % 60
    asked = requests.withColumn("requested_at", F.timestamp_seconds(second))
    told = _reports(requests).withColumn("reported_at", F.timestamp_seconds(second + 5 + F.col("attempt"))).drop("attempt")
    folder = f"{shared_dir(spark)}/reports-{uuid4()}"
    streams = []
    for name, rows, time in (("asked", asked, "requested_at"), ("told", told, "reported_at")):
        end = spark.range(1).select(
            *[F.lit({"kind": "end", "error": None}.get(c, -1)).cast(t).alias(c) for c, t in rows.dtypes if c != time],
            F.timestamp_seconds(F.lit(1_000_000)).alias(time),
        )
        rows.write.parquet(f"{folder}/{name}")
        end.write.mode("append").parquet(f"{folder}/{name}")
        streams.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 64).parquet(f"{folder}/{name}"))
    made = stream_outcomes(*streams, wait="1 minute", late="2 minutes", key="doc_id")
    outcomes = spark.read.schema(made.schema).parquet(run_available(made))
    return _wide(bt.files_report(files, outcomes, "mp3", generate_subtitles=True, key="doc_id"))


def merged_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to requests, their outcomes, and the audio files in the merged track of each document."""
    requests = prepare_corpus_from_pages(inputs.whole_pages(spark, sf))
    audio = F.concat(F.lit("mp3/"), F.col("doc_id").cast("string"), F.lit("/"), "audio_name")
    failed = F.pmod(F.col("doc_id") * 31 + F.col("utt_no"), F.lit(7)) == 1
    reported = requests.select(
        "utt_id", F.when(~failed, audio).alias("audio"), F.lit(None).cast("string").alias("subtitle"),
        F.when(failed, F.lit("No audio was received.")).alias("error"),
    )
    lengths = requests.select(audio.alias("path"), (F.length("text").cast("bigint") * 60).alias("duration_ms"))
    return _wide(merged_track(requests, reported, lengths).drop("digits"))


def prepare_corpus_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the stages of the flagship plan passed, counted in the run that makes the requests."""
    counts = StageCounts()
    made = prepare_corpus(inputs.texts(spark, sf), sentences_per_utterance=2, counts=counts)
    made.write.format("noop").mode("overwrite").save()
    return counts.table(spark)


def _document_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = read_table(spark, f"{sf}/documents.parquet", "doc_id", "text").schema
    # A pattern, since the file source takes folders and patterns but no single file.
    return spark.readStream.schema(schema).parquet(f"{sf}/documents*.parquet").repartition(
        2 * spark.sparkContext.defaultParallelism
    )


def utterances_stream(spark: SparkSession, sf: str) -> DataFrame:
    made = stream_utterances(inputs.noisy(_document_stream(spark, sf)))
    return _wide(spark.read.schema(made.schema).parquet(run_available(made)))


def phrases_stream(spark: SparkSession, sf: str) -> DataFrame:
    docs = _document_stream(spark, sf)
    made = stream_phrases(ph.word_events(inputs.events_of(docs)))
    return spark.read.schema(made.schema).parquet(run_available(made))


def phrases_stream_blocks(spark: SparkSession, sf: str) -> DataFrame:
    words = ph.word_events(inputs.events_of(_document_stream(spark, sf)))
    path = new_run(spark)
    write_phrase_batches(words, path).awaitTermination()
    return read_phrase_batches(spark, path)


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(prepare_corpus(inputs.texts(spark, sf), sentences_per_utterance=2))


def corpus_from_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(prepare_corpus_from_pages(inputs.whole_pages(spark, sf)))


def corpus_from_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Every text in chunks of 97 characters; texts of more than 16 pages are never put together."""
    texts = inputs.texts(spark, sf)
    cuts = F.sequence(F.lit(0), F.length("text"), F.lit(97))
    chunks = texts.select("doc_id", "text", F.posexplode(cuts).alias("chunk_no", "cut"))
    chunks = chunks.select("doc_id", "chunk_no", F.substring("text", F.col("cut") + 1, F.lit(97)).alias("text"))
    return _wide(prepare_corpus_from_chunks(chunks, max_pages=16, sentences_per_utterance=2))


def all_queries() -> dict[str, Query]:
    return {
        "work_list_union": work_list_union,
        "file_identity": file_identity,
        "undecodable_rows": undecodable_rows,
        "work_files": work_files,
        "work_files_stream": work_files_stream,
        "exported_files": exported_files,
        "page_assembly": page_assembly,
        "normalized_text": _on_texts(nz.normalize),
        "clean_lines": _on_texts(nz.clean_lines),
        "dropped_lines": _on_texts(nz.dropped_lines),
        "rule_hits": _on_texts(nz.rule_hits),
        "paragraph_ids": _on_texts(nz.paragraph_ids),
        "paragraphs": _on_texts(nz.paragraphs),
        "normalize_stats": _on_texts(nz.normalize_stats),
        "sentences": _on_texts(lambda d: st.sentences(nz.normalize(d))),
        "raw_sentences": _on_texts(st.sentences),
        "utterances": _on_texts(_utterances),
        "utterances_n2": _on_texts(lambda d: _utterances(d, 2)),
        "utterance_counts": _on_texts(lambda d: st.utterance_counts(nz.normalize(d), 2)),
        "utterances_stream": utterances_stream,
        "srt_detect": _on_files(sb.srt_detect),
        "srt_cues": _on_files(sb.srt_cues),
        "srt_flat_text": _on_files(sb.srt_flat_text),
        "srt_time_to_ms": srt_time_to_ms,
        "ms_to_srt_time": ms_to_srt_time,
        "render_srt": _on_files(sb.render_srt),
        "cue_placement": _on_files(sb.cue_placement),
        "cue_track_length": _on_files(sb.cue_track_length),
        "word_times": lambda spark, sf: _wide(ph.word_times(inputs.events_and_fixture(spark, sf))),
        "phrase_breaks": _on_words(ph.phrase_breaks),
        "phrases": _on_words(ph.phrases),
        "phrases_stream": phrases_stream,
        "phrases_stream_blocks": phrases_stream_blocks,
        "phrases_to_srt": _on_words(lambda w: ph.phrases_to_srt(ph.phrases(w))),
        "synthesis_manifest": synthesis_manifest,
        "manifest_errors": manifest_errors,
        "batch_outcomes": _on_outcomes(lambda o: o),
        "output_files": _on_outcomes(mf.output_files),
        "batch_summary": batch_summary,
        "batch_summary_lines": _on_outcomes(mf.batch_summary_lines),
        "batch_requests": batch_requests,
        "batch_report": batch_report,
        "batch_report_stream": batch_report_stream,
        "merged_tracks": merged_tracks,
        "prepare_corpus_counts": prepare_corpus_counts,
        "cue_skip_report": _on_cue_outcomes(lambda files, p, o: mf.cue_skip_report(sb.routed(files), p, o)),
        "placed_cues": _on_cue_outcomes(lambda files, p, o: mf.placed_cues(p, o)),
        "track_order": _on_tracks(tl.track_order),
        "track_timeline": _on_tracks(tl.track_timeline),
        "album_length": _on_tracks(tl.album_length),
        "prepare_corpus": corpus,
        "prepare_corpus_from_pages": corpus_from_pages,
        "prepare_corpus_from_chunks": corpus_from_chunks,
    }
