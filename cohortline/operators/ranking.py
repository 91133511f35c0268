from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions import row_count

from cohortline.workspace import Workspace

_ROW_BITS = 33


def first_per_group(frame: DataFrame, group: str | list[str], *order: Column) -> DataFrame:
    """The first row of every group, rows beyond it dropped before the shuffle."""
    window = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*order)
    return frame.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def top_k(frame: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows in an order that leaves no ties: k rows per task, then k of those."""
    return frame.orderBy(*order).limit(k)


def rows_of_top_members(frame: DataFrame, member: str, amount: str, k: int) -> DataFrame:
    """All rows of the k members with the largest sum; the k names are broadcast."""
    sums = frame.groupBy(member).agg(F.sum(amount).alias("_sum"))
    leaders = top_k(sums, k, F.col("_sum").desc(), F.col(member)).select(member)
    return frame.join(F.broadcast(leaders), member, "left_semi")


def number_rows(frame: DataFrame, name: str, workspace: Workspace, *order: Column) -> DataFrame:
    """Position 1..n in a total order, without one task ever seeing all rows.

    Rows are range-partitioned, sorted inside their partition and written with
    (partition, index) packed in one id. Partition sizes give each partition's
    offset; that list is as long as there are partitions. Writing first pins the
    partition bounds, which are sampled and could differ on a second evaluation.
    """
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    written = workspace.write_fresh(ordered.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    split = F.shiftrightunsigned("_id", _ROW_BITS)
    sizes = written.groupBy(split.alias("_split")).agg(row_count().alias("_rows"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_split", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    index = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        written.withColumn("_split", split)
        .join(F.broadcast(offsets), "_split")
        .select((F.col("_offset") + index + 1).alias(name), *frame.columns)
    )
