from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.plans.staging import TRIAL_COLUMNS
from cohortline.warehouse import LAYERS, MODELS, Warehouse


def register_views(w: Warehouse, only: set[str] | None = None) -> None:
    """Every model under its own name as a temporary view."""
    for name, model in MODELS.items():
        if model.layer in LAYERS and (only is None or name in only):
            w.table(name).createOrReplaceTempView(name)


def _point(w: Warehouse, database: str, name: str, path: str) -> None:
    """``database.name`` shows the files of ``path``; readers of the table see the former or the new ones."""
    spark, table = w.spark, f"{database}.{name}"
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == w.table(name).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")


def publish_tables(w: Warehouse, layer: str, only: set[str] | None = None) -> None:
    """The written models of a layer as ``layer.name`` tables over their files."""
    w.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, model in MODELS.items():
        if model.layer == layer and model.written and (only is None or name in only):
            w.table(name)
            _point(w, layer, name, w.workspace.path(layer, name))


def staging_statements() -> dict[str, str]:
    """The lazy staging models as SQL over the published parsed tables."""
    key = ", ".join(f"coalesce({c}, '')" for c in ("application_number", "submission_type", "submission_number"))
    return {
        "stg_trials": f"SELECT {', '.join(TRIAL_COLUMNS)} FROM parsed.studies_parsed",
        "stg_trial_conditions": "SELECT nct_id, explode(conditions) AS condition_name FROM parsed.studies_parsed",
        "stg_trial_interventions": "SELECT nct_id, i.name AS intervention_name, i.type AS intervention_type "
        "FROM parsed.studies_parsed LATERAL VIEW explode(interventions) AS i",
        "stg_approvals": f"SELECT md5(concat_ws('||', {key})) AS approval_key, * FROM (SELECT application_number, "
        "sponsor_name, s.submission_type, s.submission_number, s.submission_status, s.submission_status_date, "
        "s.review_priority, source_fetched_at FROM parsed.applications_parsed LATERAL VIEW explode(submissions) AS s)",
    }


def publish_staging(w: Warehouse, only: set[str] | None = None) -> None:
    """The ``staging`` schema: views over the published parsed tables, and its stored models.

    They are in the catalog, so another session reads them too.
    """
    publish_tables(w, "parsed", only)
    publish_tables(w, "staging", only)
    for name, statement in staging_statements().items():
        if only is None or name in only:
            w.spark.sql(f"CREATE OR REPLACE VIEW staging.{name} AS {statement}")


def append_audit(exclusions: DataFrame, log: str) -> None:
    """One more entry of history per run; earlier entries stay. Ids grow with time."""
    now = F.current_timestamp()
    entry = exclusions.select(F.unix_micros(now).alias("log_id"), "*", now.alias("logged_at"))
    entry.write.mode("append").parquet(log)


def read_audit(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log)
