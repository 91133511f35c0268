from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partial_date(text: Column) -> Column:
    """``2020-07-15`` as is, ``2020-07`` as the first of that month, else NULL."""
    return F.when(F.length(text) == 10, text.cast("date")).when(
        F.length(text) == 7, F.concat(text, F.lit("-01")).cast("date")
    )


def compact_date(text: Column) -> Column:
    """``20200715`` as a date; any other shape is NULL."""
    return F.when(text.rlike(r"^\d{8}$"), F.to_date(text, "yyyyMMdd"))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end, negative when end comes first."""
    return F.date_diff(end, start)


def year_span(first: Column, last: Column) -> Column:
    """Every year from first to last; empty when last precedes first.

    ``sequence`` alone would count downwards for a reversed pair.
    """
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
