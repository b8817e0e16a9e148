"""Mixing sources to target weights, with DataFrame operations only.

Each row gets a random key that is a hash of its id and content. Rows are range-sorted by
source and key, word counts are summed along that order (inside each range, plus the sum of
the ranges before), and each source is cut exactly where its target is reached. A target above
the source's size takes whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import free_name, settle
from voxloom.operators.blocks import range_blocks, running_totals

# The weights that sources get in their order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MOST_EPOCHS = 2
SEED = 20240817
WORD = r"[^\x20\x09-\x0D]+"


def targets(
    sizes: dict[str | None, int],
    weights: dict[str | None, float],
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> dict[str | None, float]:
    """Words to take from each source: its share by weight of share x all words, at most
    most x its own size; what a full source leaves goes to the others by weight."""
    left, result, open_sources = share * sum(sizes.values()), {}, set(sizes)
    while open_sources:
        total = sum(weights[s] for s in open_sources)
        full = {s for s in open_sources if left * weights[s] / total > most * sizes[s]}
        if not full:
            return result | {s: left * weights[s] / total for s in open_sources}
        for s in full:
            result[s] = float(most * sizes[s])
            left -= result[s]
        open_sources -= full
    return result


def cyclic_weights(sources: list[str | None]) -> dict[str | None, float]:
    """3, 1, 2, repeating, over the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(ordered)}


def _source_table(spark: SparkSession, rows: DataFrame, weigh, share, most) -> DataFrame:
    """One row for each source; the only thing that passes the driver, so a mixture is over
    named sources (thousands), not over hosts."""
    sizes = {
        r["_source"]: int(r["n"])
        for r in rows.groupBy("_source").agg(F.sum("_size").alias("n")).collect()
    }
    goal = targets(sizes, weigh(list(sizes)), share, most)
    listed = [(s, sizes[s], goal[s]) for s in sizes]
    return spark.createDataFrame(listed, "_source string, _source_size bigint, _target double")


def _rows(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Rows with a name of their own: the hash of the text, and a number among equal rows."""
    named = docs.withColumns(
        {
            "_size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint"),
            "_hash": F.xxhash64(key, text, source),
            "_source": F.col(source).cast("string"),
        }
    )
    order = Window.partitionBy(key, "_hash").orderBy("_source")
    return named.withColumn("_copy", F.row_number().over(order))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weigh=cyclic_weights,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """A row for each row of docs: key, size, source_size, target, taken, and _hash, _copy.

    size is the number of words (null text: 0). taken counts the words that the mix takes of
    the row, whole epochs first; the document at the cut gives its first words only, so the
    words of a source sum up to its target, rounded down. The order is fixed by hashes of the
    content, so reruns agree; repeated rows are separate. A null source is a source. Rows with
    a null key are rows like any other. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(source).alias("_from")
    )
    rows = settle(
        _rows(narrow, "_key", "_text", "_from").select("_key", "_hash", "_copy", "_source", "_size")
    )
    table = settle(_source_table(spark, rows, weigh, share, most))
    rows = rows.withColumn("_random", F.xxhash64(F.lit(SEED), "_key", "_hash", "_copy"))
    blocks = range_blocks(rows, ["_source", "_random", "_key", "_copy"])
    # Totals are joined on the source, and null joins with nothing: a marked name stands for it.
    blocks = blocks.withColumn("_mark", F.coalesce(F.concat(F.lit("="), "_source"), F.lit("null")))
    summed = running_totals(
        blocks, "_mark", ["_random", "_key", "_copy"], {"_before": F.col("_size")}
    )
    joined = summed.join(
        table.withColumnRenamed("_source", "_named"), F.col("_source").eqNullSafe(F.col("_named"))
    )
    epochs = F.when(
        F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))
    ).otherwise(F.lit(0))
    rest = F.floor(F.col("_target") - epochs * F.col("_source_size"))
    partial = F.least(F.col("_size"), F.greatest(F.lit(0), rest - F.col("_before")))
    return joined.select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (epochs * F.col("_size") + partial).cast("bigint").alias("taken"),
        "_hash",
        "_copy",
    )


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The documents of the mix: a row for each epoch that takes one, with the columns of docs.

    The document at a source's cut comes with its first words only (white space between them
    as in the text). Documents without words are taken by no epoch and are left out.
    """
    taken = settle(
        mix(docs, key, text, source, **options)
        .filter(F.col("taken") > 0)
        .select(F.col(key).alias("_key"), "_hash", "_copy", "size", "taken")
    )
    clash = {c: free_name(docs, c) for c in ("_key", "_hash", "_copy", "size", "taken", "_epoch")}
    taken = taken.withColumnsRenamed({c: clash[c] for c in taken.columns})
    mine, number = free_name(docs, "_mine"), free_name(docs, "_nth")
    rows = docs.withColumn(mine, F.xxhash64(F.col(key), F.col(text), F.col(source)))
    order = Window.partitionBy(key, mine).orderBy(F.col(source).cast("string"))
    rows = rows.withColumn(number, F.row_number().over(order))
    joined = rows.join(
        taken,
        F.col(key).eqNullSafe(F.col(clash["_key"]))
        & (F.col(mine) == F.col(clash["_hash"]))
        & (F.col(number) == F.col(clash["_copy"])),
    )
    size, words = F.col(clash["size"]), F.col(clash["taken"])
    epochs = joined.withColumn(
        clash["_epoch"], F.explode(F.sequence(F.lit(1), F.ceil(words / size).cast("int")))
    )
    count = F.least(size, words - (F.col(clash["_epoch"]) - 1) * size)
    # The cut document's first words, with the white space that stands between them.
    pieces = F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*+" + WORD), 0), 1, count.cast("int"))
    cut = F.when(count < size, F.array_join(pieces, "")).otherwise(F.col(text))
    replaced = epochs.withColumn(text, cut)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced = replaced.withColumn("n_chars", F.char_length(text).cast(kind))
    return replaced.select(*docs.columns)
