from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, digits: int | None = 4) -> Column:
    """``part / whole`` as a double, NULL on a zero whole, optionally rounded."""
    value = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    return value if digits is None else F.round(value, digits)


def row_count() -> Column:
    """Aggregate: number of rows."""
    return F.count(F.lit(1))


def rate(condition: Column, digits: int | None = None) -> Column:
    """Aggregate: share of rows on which a boolean holds, NULLs left out."""
    value = F.avg(condition.cast("int"))
    return value if digits is None else F.round(value, digits)


def round_rates(frame: DataFrame, digits: int = 4) -> DataFrame:
    """Round every ``*_rate`` column."""
    return frame.select(
        *(
            F.round(F.col(name).cast("double"), digits).alias(name) if name.endswith("_rate") else F.col(name)
            for name in frame.columns
        )
    )
