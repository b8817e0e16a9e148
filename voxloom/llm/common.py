"""What the operators share: Python columns over texts, words, files in the shared folder."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxloom.operators.blocks import scope, settle, shared_dir, small_side

__all__ = [
    "columns_from_text", "free_name", "one_row_of_each_id", "one_task_each", "read_docs", "scope",
    "settle", "shared_dir", "small_side", "word_blocks",
]

# Texts are turned into Python strings in slices of about so many bytes.
SLICE_BYTES = 4 << 20

# A very long text is split into words in blocks of so many bytes.
BLOCK_BYTES = 4 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")

TextFunction = Callable[[list[str | None]], list]


def read_docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns_from_text(
    df: DataFrame, text: str, fields: str, make: Callable[[], TextFunction], slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Append columns that a Python function computes from whole texts.

    make() is called once in each task; what it returns takes a list of texts and gives one
    list (or array) per field. There is no shuffle, and a lost task is simply run again. An
    input column with the name of a new one is replaced. Rows go through as Arrow batches,
    in slices of about slice_bytes bytes.
    """
    added = T.StructType.fromDDL(fields)
    names = {f.name.lower() for f in added}
    if text.lower() in names:
        raise ValueError(f"a new column may not be named like the text column {text!r}")
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    schema = T.StructType([*kept.schema.fields, *added.fields])
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in slices(batch, slice_bytes):
                made = function(part.column(part.schema.get_field_index(text)).to_pylist())
                arrays = [pa.array(v, type=f.type) for v, f in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *arrays], names=[*part.schema.names, *arrow.names]
                )

    return kept.mapInArrow(frugal(run), schema)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of a task's batches, which gives freed memory back when the task ends.

    Python workers outlive their tasks, and what Arrow and the allocator keep of one stage
    would count beside the next stage's memory for as long as the worker waits.
    """

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    """Free memory that Arrow's pool and the C library hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive slices of about size bytes, one row at least."""
    rows = batch.num_rows
    step = max(1, min(rows, int(rows * size / max(1, batch.nbytes)))) if rows else 1
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """Words between ASCII white space, as UTF-8 with A-Z in lower case, in blocks."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > BLOCK_BYTES:
            cut = _SPACE.search(data, start + BLOCK_BYTES)
            end = cut.start() if cut else end
        yield data[start:end].split()  # bytes split at \x20 and \x09-\x0D
        start = end


def one_row_of_each_id(df: DataFrame, key: str, text: str) -> DataFrame:
    """All columns of one row for each id; rows without an id stay.

    Of rows that repeat an id that with the smallest hash of its text stays, then that with the
    smallest hash of the whole row. Only rows whose id repeats are shuffled, and combined
    before that, so one id may hold any part of them.
    """
    name, columns = free_name(df, "_id"), [F.col(f"`{c}`") for c in df.columns]
    again = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias("_n"))
    again, found = small_side(settle(again.filter("_n > 1").select(name)))
    if not found:
        return df
    repeated = df.join(again, df[key] == again[name], "left_semi")
    order = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(*columns).alias("b"))
    best = repeated.groupBy(F.col(key).alias(name)).agg(F.min_by(F.struct(*columns), order).alias("_row"))
    return df.join(again, df[key] == again[name], "left_anti").unionByName(best.select("_row.*"))


def one_task_each(names: DataFrame, column: str) -> DataFrame:
    """Spread the names of large things, a row each, over as many tasks (10,000 at most).

    The number is given, so adaptive execution does not join the small rows in one task.
    """
    names = settle(names)
    return names.repartition(max(1, min(names.count(), 10_000)), column)


def open_output(uri: str):
    """A stream that writes the file; the file system follows from the URI's scheme."""
    system, path = pafs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A random-access file for reading."""
    system, path = pafs.FileSystem.from_uri(uri)
    return system.open_input_file(path)
