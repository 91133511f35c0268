from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def trimmed_or_null(text: Column) -> Column:
    """Text without surrounding spaces; NULL if nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def joined_or_null(items: Column, separator: str = "|") -> Column:
    """Array of text joined into one value; NULL for an empty or missing array."""
    return F.nullif(F.array_join(items, separator), F.lit(""))
