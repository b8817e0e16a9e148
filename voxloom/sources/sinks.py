"""Writers. Every table is replaced as a whole, so no stale row survives a rerun."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voxloom.sources.files import write_text_files


def write_table(df: DataFrame, path: str) -> None:
    """Parquet table; the form the next stage reads."""
    df.write.mode("overwrite").parquet(path)


def export_text(df: DataFrame, path: str, text: str, folder: str, name: str) -> None:
    """A text file for each row, such as ``7/sentence_0001.txt``, byte for byte. For hand-over;
    the table is what the next stage reads."""
    write_text_files(df, path, text, name, folder)
