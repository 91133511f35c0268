"""Operators on yearly series. Input is already one row per year or per member and
year, so these windows hold as many rows as there are years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def add_lag(frame: DataFrame, name: str, value: str, order: str, *partition: str) -> DataFrame:
    """Value of the previous existing row; gaps in the series are not filled."""
    window = Window.partitionBy(*partition).orderBy(order)
    return frame.withColumn(name, F.lag(value).over(window))


def add_launch_value(frame: DataFrame, name: str, value: str, partition: str, order: str) -> DataFrame:
    """Value of the partition's first row on every row."""
    window = (
        Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return frame.withColumn(name, F.first(value).over(window))


def add_share(frame: DataFrame, name: str, value: str, *partition: str) -> DataFrame:
    """Value over the sum of its partition."""
    return frame.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*partition)))


def split_at(frame: DataFrame, year: str, cutoff: int) -> DataFrame:
    """The series as two overlapping segments; the cutoff year is in both."""
    segments: list[tuple[str, Column]] = [
        ("reliable", F.col(year) <= cutoff),
        ("censored", F.col(year) >= cutoff),
    ]
    labels = F.array_compact(F.array(*(F.when(inside, F.lit(label)) for label, inside in segments)))
    return frame.withColumn("segment", F.explode(labels))
