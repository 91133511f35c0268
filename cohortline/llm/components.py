"""Connected components of a link table, by alternating large-star and small-star steps.

Every step replaces links by links to a smaller neighbour and keeps connectivity; when
nothing changes, each vertex is linked to the smallest of its component. State is the
link table alone, written between rounds; minima combine before the shuffle, and a
vertex with very many links is split by the skew handling of adaptive joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.store import Store


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, store: Store) -> DataFrame:
    """id, component (the smallest reachable id) of every vertex with a link to another.

    ``links`` has two columns of one orderable type; loops and repeats are harmless.
    """
    one, two = links.columns
    current = store.write(
        links.where(F.col(one) != F.col(two)).select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v")).distinct(),
        "links",
    )
    mark = None
    while True:
        # Two numbers per round come to the driver.
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
        current = store.write(_small_star(_large_star(current)).distinct(), "links")
    ends = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.union(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
