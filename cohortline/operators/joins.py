"""Joins of facts with lookup tables.

Whether a lookup table is broadcast is left to Spark, which compares the size of its
stored files, or of its shuffled rows at run time, with
``spark.sql.autoBroadcastJoinThreshold``. Beyond that, both sides are shuffled once and
adaptive execution splits the partitions of hot keys and of NULL, repeating the few
lookup rows they meet. The fact is read and shuffled once either way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import normalized_name, row_count


def lookup(fact: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Rows of the fact with the columns of a dimension that is unique on ``on``; left or inner."""
    return fact.join(dimension, [on] if isinstance(on, str) else list(on), how)


def lookup_with_null(fact: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Left lookup on a text key for which NULL is a key like any other."""

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.select("*", F.col(on).isNull().alias("_none"), F.coalesce(on, F.lit("")).alias("_value"))

    return lookup(keyed(fact), keyed(dimension).drop(on), ["_none", "_value"]).drop("_none", "_value")


def match_by_name(fact: DataFrame, names: DataFrame, name: str, normalized: str) -> DataFrame:
    """Left lookup of a normalized name; ``matched`` tells whether there was one.

    ``names`` is unique on ``normalized``.
    """
    found = names.select("*", F.lit(True).alias("matched"))
    matched = lookup(fact.withColumn(normalized, normalized_name(F.col(name))), found, normalized)
    return matched.withColumn("matched", F.col("matched").isNotNull()).drop(normalized)


def with_summary(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Every row with the columns of a one-row result, taken as a scalar subquery."""
    packed = summary.select(F.struct(*summary.columns)).scalar()
    return rows.select("*", packed.alias("_summary")).select(*rows.columns, "_summary.*")


def one_row(*frames: DataFrame) -> DataFrame:
    """Single-row results side by side."""
    return reduce(with_summary, frames)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys missing in the parent, with the number of child rows each.

    Children are counted per key before the join, so a key held by a third of the
    rows is one row of it. NULL keys are not checked.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        row_count().alias("child_rows")
    )
    return counted.join(parent, F.col("_key") == parent[parent_key], "left_anti").withColumnRenamed("_key", key)
