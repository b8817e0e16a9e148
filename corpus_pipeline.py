"""Documents -> token files, in five stages; each reads what the one before it kept.

The first three keep whole documents or drop them, the fourth repeats and cuts them to the
weights of their sources, and the last writes token files and returns what it reads back.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm.common import read_docs, shared_dir
from voxloom.llm.decontaminate import decontaminated
from voxloom.llm.language import identified
from voxloom.llm.mixing import mixed_documents
from voxloom.llm.near_dedup import keep_one_of_each
from voxloom.llm.queries import token_rows


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those that resemble no labelled language."""
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its five-word shingles."""
    return keep_one_of_each(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item occurs."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; a row for each document as read back from them."""
    return token_rows(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixture", source_mixture),
    ("token_output", token_output),
]

# SQL has no SimHash, CGK embedding or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written in the shared folder and read again."""
    docs = read_docs(spark, sf_dir)
    folder = f"{shared_dir(spark)}/pipeline-{uuid4()}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
