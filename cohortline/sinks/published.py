"""What a refresh has published: all tables of one run, switched by one write.

A manifest names the run and the folder of every table. Whoever opens it reads the tables of
that run and of no other, also while the next one is being published. Two runs that publish
at once build on the same manifest; the second is told so (``manifest.Conflict``) and has
published nothing. A run of which only some branches passed carries the other tables over
from the run before.

Answers to statements can be kept beside the run they were computed from; a new run has none.
"""

from __future__ import annotations

import hashlib
import json
import string
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortline.manifest import Manifests
from cohortline.sinks.layers import staging_statements
from cohortline.warehouse import MODELS, Warehouse

PUBLISHED = ("parsed", "staging", "marts", "metrics")
# Seconds for which an answer is kept.
KEPT_FOR = 3_600


def manifests(spark: SparkSession, folder: str) -> Manifests:
    return Manifests(spark, f"{folder}/published")


def publish_run(w: Warehouse, folder: str, since: int, only: set[str] | None = None) -> int:
    """Make the written tables of ``w`` the published ones, if version ``since`` still is the newest."""
    known = manifests(w.spark, folder)
    tables = dict(known.read(since)["tables"]) if since else {}
    for name, model in MODELS.items():
        if model.written and model.layer in PUBLISHED and (only is None or name in only):
            w.table(name)
            tables[name] = w.workspace.path(model.layer, name)
    return known.commit(since, {"tables": tables})


def forget_runs(spark: SparkSession, folder: str, keep: int) -> None:
    """Remove all published versions but the newest ``keep``, and the runs that only they, or none, refer to.

    Runs begun after the newest published one are not touched.
    """
    known = manifests(spark, folder)
    versions = known.versions()
    kept = versions[-max(1, keep) :]
    runs = f"{folder}/runs/"
    held = [{path.removeprefix(runs).split("/")[0] for path in known.read(v)["tables"].values()} for v in kept]
    used = set().union(*held)
    for version in versions[: -len(kept)]:
        known.forget(version)
        known.delete(f"{folder}/answers/{version:012d}")
    for name in known.folders(runs):
        if name not in used and name < max(used, default=""):
            known.delete(f"{runs}{name}")


@dataclass(frozen=True)
class Published:
    """The tables of one version."""

    spark: SparkSession
    folder: str
    version: int
    tables: dict[str, str]

    @property
    def names(self) -> list[str]:
        return [*self.tables, *(name for name in staging_statements() if name not in self.tables)]

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.spark.read.parquet(self.tables[name])
        statement = staging_statements()[name]
        for parsed in ("studies_parsed", "applications_parsed"):
            if parsed in self.tables:
                statement = statement.replace(f"parsed.{parsed}", f"parquet.`{self.tables[parsed]}`")
        return self.spark.sql(statement)

    def sql(self, statement: str, args: dict | None = None) -> DataFrame:
        """A statement over tables in braces: ``SELECT count(*) FROM {fct_trials}``."""
        used = {name for _, name, _, _ in string.Formatter().parse(statement) if name}
        return self.spark.sql(statement, args=args, **{name: self.table(name) for name in used})

    def answer(self, statement: str, args: dict | None = None, kept_for: float = KEPT_FOR) -> DataFrame:
        """The statement's rows, stored when first asked for and read from there until they expire.

        Answers are stored, not collected. Two sessions that ask at once each store one; the
        marker names the one to read.
        """
        known = manifests(self.spark, self.folder)
        asked = json.dumps([statement, sorted((args or {}).items())], default=str)
        place = f"{self.folder}/answers/{self.version:012d}/{hashlib.sha256(asked.encode()).hexdigest()}"
        marks = Manifests(self.spark, f"{place}/marks")
        since, mark = marks.newest()
        if since and time.time() - mark["at"] < kept_for:
            return self.spark.read.parquet(mark["path"])
        target = f"{place}/{time.time_ns():020d}"
        self.sql(statement, args).write.parquet(target)
        marks.commit(marks.newest()[0], {"path": target, "at": time.time()})
        if since:
            known.delete(mark["path"])
        return self.spark.read.parquet(target)


def open_run(spark: SparkSession, folder: str, version: int | None = None) -> Published:
    """The newest published version, or a former one that has not been removed."""
    known = manifests(spark, folder)
    newest, content = known.newest()
    if not newest:
        raise FileNotFoundError(f"nothing has been published in {folder}")
    if version is not None and version != newest:
        newest, content = version, known.read(version)
    return Published(spark, folder, newest, content["tables"])
