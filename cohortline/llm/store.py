"""Tables written between the steps of an operator, in the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortline.workspace import Workspace


class Store:
    """One operator run's private folder below ``spark.checkpoint.dir``.

    A written table cuts lineage: its rows are the same for every reader, also after
    executors have been lost, and its size is known to later joins.
    """

    def __init__(self, frame: DataFrame, name: str):
        self.workspace = Workspace(frame.sparkSession)
        self.name = name

    def write(self, frame: DataFrame, part: str) -> DataFrame:
        return self.workspace.write_fresh(frame, f"{self.name}-{part}")

    def folder(self, part: str) -> str:
        return self.workspace.fresh(f"{self.name}-{part}")


def small_batches(frame: DataFrame, rows: int = 1_000) -> None:
    """Bounds the rows of an Arrow batch, so that long texts do not fill a worker."""
    session = frame.sparkSession
    if int(session.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
