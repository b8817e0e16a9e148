"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from uuid import uuid4

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import (
    decontaminate, language, licenses, mixing, periodic, prefix_trie, sharding, token_files, tokens, toxicity, warc,
)
from voxloom.llm.common import read_docs, settle, shared_dir
from voxloom.llm.fingerprint import edited_documents, find_within, likeness
from voxloom.llm.near_dedup import hamming_components
from voxloom.llm.simhash import hex_digits

VOCABULARY = "word_bpe_49k.json"


def _fold(key: Column, folds: int) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hamming_components(read_docs(spark, sf_dir, "doc_id", "text"), words=3, radius=3)
    return found.select("doc_id", hex_digits(F.col("f0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_within: documents within 3 bits, itself included, for ids divisible by 20."""
    rows = edited_documents(read_docs(spark, sf_dir, "doc_id", "text"))
    rows = rows.withColumn("asked", F.col("doc_id") % 20 == 0)
    found = find_within(rows, rows.filter("asked"))
    copies = rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    near = found.join(copies.withColumnRenamed("fingerprint", "found"), "found")
    near = settle(near.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("n").alias("n_within")))
    joined = rows.join(near.withColumn("asked", F.lit(True)), ["fingerprint", "asked"], "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_digits(F.col("fingerprint")).alias("fingerprint"),
        hex_digits(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "n_within",
    )


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    index = warc.write_archives(pages, warc.archive_folder(spark))
    return warc.read_archives(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that occurs in it."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = decontaminate.with_matches(read_docs(spark, sf_dir, "doc_id", "text"), benchmark)
    hits = docs.select("doc_id", F.explode("matches").alias("m"))
    return hits.select(
        "doc_id",
        F.col("m.item_id").alias("item_id"),
        F.col("m.start").alias("start_word"),
        F.col("m.words").alias("n_words"),
        F.col("m.edits").alias("edits"),
    )


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/shards-{uuid4()}"
    shards = sharding.write_shards(read_docs(spark, sf_dir, "doc_id", "text"), path)
    return sharding.slots(shards).select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    judged = toxicity.scored(
        read_docs(spark, sf_dir, "doc_id", "text"),
        labels,
        learn_from=lambda key: _fold(key, 5) != 0,
        fold=lambda key: _fold(key, 5) == toxicity.CALIBRATION_FOLD,
    )
    return judged.select("doc_id", (_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "doc_id", "text", "lang")
    held_out = _fold(F.col("doc_id"), 4) == 2
    known = language.profiles(docs.filter(~held_out))
    judged = language.predict(docs.select("doc_id", "text"), known)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "doc_id", "text").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    )
    counted = tokens.with_token_counts(docs, public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    index = token_files.write_token_files(
        docs, token_files.token_folder(spark), public_tokenizers.path(VOCABULARY)
    )
    return token_files.read_token_files(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, read_docs(spark, sf_dir, "doc_id", "text"))


def op11_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.with_notices(read_docs(spark, sf_dir, "doc_id", "text")).drop("text")
    base = licenses.exact_places(F.col("notices"), len(licenses.BASE))
    places = found.withColumn("base", base)
    return places.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.first_word").alias("first_word"),
        F.array_max("base.first_word").alias("last_word"),
        licenses.label_list(F.col("base")).alias("base_labels"),
        licenses.label_list(F.col("notices")).alias("labels"),
        licenses.confidence(F.col("notices")).alias("score"),
        "notices",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: of about one document in ten the words from a place on repeat, as their
    id says; the others are as they are. Null ids plant nothing."""

    def rewritten(doc_id: int, text: str | None) -> str | None:
        h = zlib.crc32(str(doc_id).encode())
        words = (text or "").encode("utf-8", "surrogatepass").split()
        n, g = len(words), h // 10
        if h % 10 or not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        part = words[a : a + p]
        tail = (part * (-(-(n - a) // p)))[: n - a]
        return b" ".join(words[:a] + tail).decode("utf-8", "surrogatepass")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            odd = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in ids]
            new = [
                rewritten(i, texts[k].as_py()) if planted else texts[k].as_py()
                for k, (i, planted) in enumerate(zip(ids, odd, strict=True))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(read_docs(spark, sf_dir, "doc_id", "text"))
    found = periodic.with_runs(docs).drop("text")
    # The greatest length, then the smallest start, then the smallest period.
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(ranked)
    rows = found.withColumn("best", best)
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.trie_nodes(prefix_trie.with_heads_of(lists, 20, 3, _fold(F.col("conv_id"), 4).cast("int")))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_simhash_near_dedup, op2_document_fingerprints, op3_warc_archives, op4_source_mixture,
            op5_benchmark_leaks, op6_histogram_shards, op7_toxicity, op8_language_id,
            op9_token_counts, op10_token_files, op11_license_notices, op12_periodic_runs,
            op13_conversation_trie,
        )
    }
