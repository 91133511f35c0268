from __future__ import annotations

import duckdb
import pytest
from corpus import CLASHES, SCHEMA, SF_DIR

from cohortline.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def base(spark):
    """A benchmark table as plain rows."""

    def read(name: str, columns: str) -> list[tuple]:
        return duckdb.sql(f"select {columns} from '{SF_DIR}/{name}.parquet' order by 1").fetchall()

    return read


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with clashing extra columns."""

    def make(*given: tuple, clashes: bool = True):
        filled = [(*row, *("en", "web")[: 4 - len(row)]) if len(row) < 4 else row for row in given]
        rows = [(*row, len(row[1] or "")) for row in filled]
        frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
        for name in CLASHES if clashes else ():
            frame = frame.withColumn(name, frame["lang"])
        return frame

    return make
