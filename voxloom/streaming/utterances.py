"""Documents as a stream -> utterances. The batch operators, unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voxloom.operators.normalize import normalize
from voxloom.operators.sentences import utterances


def stream_utterances(
    docs: DataFrame,
    sentences_per_utterance: int = 1,
    prefix: str = "sentence",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Row-local and stateless, so rows come out with the micro-batch they came in."""
    return utterances(normalize(docs, key, text), sentences_per_utterance, prefix, key)
