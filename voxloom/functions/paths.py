"""File identity from a path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The last dot starts the extension, unless only dots stand before it.
_STEM_AND_EXTENSION = r"(?s)^(\.*[^.].*)(\.[^.]*)$"


def file_name(path: Column) -> Column:
    """The part after the last slash."""
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Extension with its dot, or the empty string."""
    return F.regexp_extract(file_name(path), _STEM_AND_EXTENSION, 2)


def base_name(path: Column) -> Column:
    """File name without its extension."""
    return F.regexp_replace(file_name(path), _STEM_AND_EXTENSION, "$1")
