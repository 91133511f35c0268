"""The tables of one registry load, built on first use.

A model is a function of DataFrames; its parameters name the tables it reads.
Tables that several models read are written once below the workspace; the rest
stay lazy and become part of their reader's plan.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortline.plans import marts, metrics, staging
from cohortline.sources import benchmark_tables, documents
from cohortline.workspace import Workspace


@dataclass(frozen=True)
class Model:
    layer: str
    build: Callable[..., DataFrame]
    written: bool = True
    # Each row comes out of one row of the inputs.
    row_local: bool = False

    @property
    def inputs(self) -> list[str]:
        return list(inspect.signature(self.build).parameters)


MODELS = {
    "studies_parsed": Model("parsed", documents.parse_studies),
    "applications_parsed": Model("parsed", documents.parse_applications),
    "stg_trials": Model("staging", staging.stg_trials, written=False),
    "stg_sponsors": Model("staging", staging.stg_sponsors),
    "stg_trial_conditions": Model("staging", staging.stg_trial_conditions, written=False),
    "stg_trial_interventions": Model("staging", staging.stg_trial_interventions, written=False),
    "stg_approvals": Model("staging", staging.stg_approvals, written=False),
    "dim_sponsor": Model("marts", marts.dim_sponsor),
    "dim_condition": Model("marts", marts.dim_condition),
    "dim_intervention": Model("marts", marts.dim_intervention),
    "bridge_trial_condition": Model("marts", marts.bridge_trial_condition, row_local=True),
    "bridge_trial_intervention": Model("marts", marts.bridge_trial_intervention, row_local=True),
    "fct_trials": Model("marts", marts.fct_trials, row_local=True),
    "fct_approvals": Model("marts", marts.fct_approvals, row_local=True),
    "application_status": Model("shared", metrics.application_status, written=False),
    "applicant_years": Model("shared", metrics.applicant_years),
    "fda_sponsors": Model("shared", metrics.fda_sponsors),
    "trial_funnel": Model("shared", metrics.trial_funnel),
    "condition_funnel": Model("shared", metrics.condition_funnel),
    "duration_histogram": Model("shared", metrics.duration_histogram),
    "sponsor_activity": Model("shared", metrics.sponsor_activity),
    "metric_phase_transition": Model("metrics", metrics.metric_phase_transition),
    "metric_sponsor_cohorts": Model("metrics", metrics.metric_sponsor_cohorts),
    "metric_duration_trends": Model("metrics", metrics.metric_duration_trends),
    "metric_duration_trends_by_phase": Model("metrics", metrics.metric_duration_trends_by_phase),
}
RAW = ("raw_studies", "raw_applications")
LAYERS = ("staging", "marts", "metrics")


class Warehouse:
    def __init__(self, raw_studies: DataFrame, raw_applications: DataFrame, workspace: Workspace | None = None):
        self.spark: SparkSession = raw_studies.sparkSession
        self.workspace = workspace or Workspace(self.spark)
        self.sf_dir: str | None = None
        self._tables: dict[str, DataFrame] = {"raw_studies": raw_studies, "raw_applications": raw_applications}
        # Raw tables still to be landed: the folder of each.
        self._to_land: dict[str, str] = {}

    @classmethod
    def over_benchmark_tables(cls, spark: SparkSession, sf_dir: str, workspace: Workspace | None = None) -> Warehouse:
        """A warehouse whose documents are built from the benchmark tables, each source landed on first use."""
        warehouse = cls(
            benchmark_tables.raw_studies(spark, sf_dir),
            benchmark_tables.raw_applications(spark, sf_dir),
            workspace or Workspace(spark),
        )
        warehouse.sf_dir = sf_dir
        warehouse._to_land = {"raw_studies": "studies", "raw_applications": "applications"}
        return warehouse

    def plan(self, name: str) -> DataFrame:
        """A model's plan over its input tables, also if the model itself is written."""
        model = MODELS[name]
        return model.build(*(self.table(source) for source in model.inputs))

    def table(self, name: str) -> DataFrame:
        """A table by name; it and the tables it needs are built if they are not yet."""
        if name in self._to_land:
            self._tables[name] = self.workspace.write(self._tables[name], "raw", self._to_land[name])
            del self._to_land[name]
        if name not in self._tables:
            frame = self.plan(name)
            if MODELS[name].written:
                frame = self.workspace.write(frame, MODELS[name].layer, name)
            self._tables[name] = frame
        return self._tables[name]

    def rows_of(self, name: str) -> DataFrame:
        """A table's rows for one pass over some of its columns.

        A row-local model that is not written yet is computed from what it reads, these columns
        only, and stays unwritten: its keys are digests, which take far more room than what they
        are made of. Joins take ``table``, whose files have a size to decide on.
        """
        if name in self._tables or name not in MODELS or not MODELS[name].row_local:
            return self.table(name)
        return MODELS[name].build(*(self.rows_of(source) for source in MODELS[name].inputs))

    def __getattr__(self, name: str) -> DataFrame:
        if name in MODELS:
            return self.table(name)
        raise AttributeError(name)

    @property
    def raw_studies(self) -> DataFrame:
        return self.table("raw_studies")

    @property
    def raw_applications(self) -> DataFrame:
        return self.table("raw_applications")

    def build_all(self) -> None:
        """Write every written table."""
        for name in (*RAW, *MODELS):
            self.table(name)
