from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unnest(frame: DataFrame, array: str, *kept: str, **fields: str | None) -> DataFrame:
    """One row per array element; an empty or missing array gives no row.

    ``fields`` maps output names to fields of the element, or to None for the
    element itself.
    """
    rows = frame.select(*kept, F.explode(array).alias("_e"))
    return rows.select(
        *kept, *(F.col("_e" if path is None else f"_e.{path}").alias(name) for name, path in fields.items())
    )


def active_spans(trials: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Per key the year of its first start and its years of activity as disjoint spans.

    A missing end counts as active in the start year only; a reversed span has no active
    year, but its start still says when the key was first seen. Spans of one start year are
    combined before they are shuffled, touching ones are merged inside the row, so a row
    holds at most one span for every second calendar year however many trials a key has.
    """
    first = F.year(start)
    longest = (
        trials.where(F.col(start).isNotNull() & F.col(key).isNotNull())
        .select(key, first.alias("first"), F.coalesce(F.year(end), first).alias("last"))
        .groupBy(key, "first")
        .agg(F.max("last").alias("last"))
    )
    span = F.when(F.col("last") >= F.col("first"), F.struct("first", "last"))
    spans = longest.groupBy(key).agg(F.min("first").alias("first_year"), F.collect_list(span).alias("_spans"))

    def merged(done: Column, span: Column) -> Column:
        latest = F.try_element_at(done, F.lit(-1))
        longer = F.struct(latest["first"].alias("first"), F.greatest(latest["last"], span["last"]).alias("last"))
        touches = span["first"] <= latest["last"] + 1
        earlier = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(touches, F.concat(earlier, F.array(longer))).otherwise(F.concat(done, F.array(span)))

    none = F.array().cast("array<struct<first: int, last: int>>")
    return spans.select(key, "first_year", F.aggregate(F.array_sort("_spans"), none, merged).alias("spans"))


def count_by_year(frame: DataFrame, group: str, spans: str, year: str, count: str) -> DataFrame:
    """How many rows of each group are active in each year, years without any left out.

    A span adds one at its first year and takes one away after its last; these changes are
    summed per group and year, and their running total is the count. Only the summed
    changes, at most one per group and calendar year, are filled up to a row for each year.
    """
    spans_of = frame.select(group, F.explode(spans).alias("_s"))
    changes = spans_of.select(
        group,
        F.inline(
            F.array(
                F.struct(F.col("_s.first").alias("_from"), F.lit(1).alias("_change")),
                F.struct((F.col("_s.last") + 1).alias("_from"), F.lit(-1).alias("_change")),
            )
        ),
    )
    by_year = Window.partitionBy(group).orderBy("_from")
    totals = (
        changes.groupBy(group, "_from")
        .agg(F.sum("_change").alias("_change"))
        .select(
            group,
            "_from",
            F.lead("_from").over(by_year).alias("_next"),
            F.sum("_change").over(by_year.rowsBetween(Window.unboundedPreceding, 0)).alias(count),
        )
    )
    # After the last change nothing is active, so a count above zero has a next change.
    return totals.where(F.col(count) > 0).select(
        group, F.explode(F.sequence("_from", F.col("_next") - 1)).alias(year), count
    )
