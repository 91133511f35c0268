from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import row_count
from cohortline.operators.joins import lookup_with_null


def mode_per_group(frame: DataFrame, group: str, value: str, **totals: Column) -> DataFrame:
    """Most frequent value per group, ties in alphabetical order, NULL last but eligible.

    ``totals`` are additive aggregates carried along: they are computed per
    (group, value) and summed per group, so the mode and the totals of a group
    come out of the same two aggregations, both combined on the map side.
    """
    counted = frame.groupBy(group, value).agg(
        row_count().alias("_n"), *(column.alias(name) for name, column in totals.items())
    )
    first = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).isNull().alias("none"), F.col(value).alias("v")))
    return (
        counted.groupBy(group)
        .agg(first.alias("_first"), *(F.sum(name).alias(name) for name in totals))
        .select(group, F.col("_first.v").alias(value), *totals)
    )


def per_group_totals(frame: DataFrame, group: str, **totals: Column) -> DataFrame:
    """Every row with the totals of its group, NULL being a group of its own.

    An aggregate looked up, not a window: a window would sort all rows of a hot
    group in one task, while the aggregate is combined on the map side.
    """
    summed = frame.groupBy(group).agg(*(column.alias(name) for name, column in totals.items()))
    return lookup_with_null(frame, summed, group)


def value_histogram(frame: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """How often each value occurs per group."""
    return frame.groupBy(*groups, value).agg(row_count().alias("n"))


def percentile_bands(histogram: DataFrame, groups: Sequence[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles per group from a histogram.

    The histogram is a plain hash aggregation; only distinct values reach the
    percentile, whose state is therefore bounded by the value domain.
    """
    names = list(points)
    shares = F.array(*(F.lit(points[name]) for name in names))
    grouped = histogram.groupBy(*groups).agg(
        F.sum("n").alias("trial_count"), F.percentile(value, shares, F.col("n")).alias("_p")
    )
    return grouped.select(
        *groups, "trial_count", *(F.col("_p")[i].alias(name) for i, name in enumerate(names))
    )


def approval_by_application(events: DataFrame) -> DataFrame:
    """Submission events collapsed to one row per application.

    ``is_approved`` is NULL when no event of the application has a status.
    """
    approved = F.col("submission_status") == "AP"
    return events.groupBy("application_number", "sponsor_name").agg(
        F.bool_or(approved).alias("is_approved"),
        F.min(F.when(approved, F.col("approval_date"))).alias("first_approval_date"),
    )
