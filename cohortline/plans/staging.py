"""Staging: flat typed views over the parsed documents.

All but ``stg_sponsors`` are row-local. Each function names its inputs as
parameters; the parsed documents come from ``cohortline.sources.documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import row_count, surrogate_key
from cohortline.operators import mode_per_group, unnest

TRIAL_COLUMNS = [
    "nct_id",
    "brief_title",
    "overall_status",
    "phase",
    "enrollment_count",
    "start_date",
    "completion_date",
    "sponsor_name",
    "sponsor_class",
    "why_stopped",
    "has_results",
    "num_primary_outcomes",
    "num_sites",
    "source_fetched_at",
]


def stg_trials(studies_parsed: DataFrame) -> DataFrame:
    return studies_parsed.select(*TRIAL_COLUMNS)


def stg_sponsors(stg_trials: DataFrame) -> DataFrame:
    named = stg_trials.where(F.col("sponsor_name").isNotNull())
    return mode_per_group(named, "sponsor_name", "sponsor_class")


def stg_trial_conditions(studies_parsed: DataFrame) -> DataFrame:
    return unnest(studies_parsed, "conditions", "nct_id", condition_name=None)


def stg_trial_interventions(studies_parsed: DataFrame) -> DataFrame:
    return unnest(
        studies_parsed, "interventions", "nct_id", intervention_name="name", intervention_type="type"
    )


def stg_approvals(applications_parsed: DataFrame) -> DataFrame:
    events = applications_parsed.select(
        "application_number", "sponsor_name", "source_fetched_at", F.inline("submissions")
    )
    return events.select(
        surrogate_key("application_number", "submission_type", "submission_number").alias("approval_key"),
        "application_number",
        "sponsor_name",
        "submission_type",
        "submission_number",
        "submission_status",
        "submission_status_date",
        "review_priority",
        "source_fetched_at",
    )


def excluded_documents(unreadable: DataFrame, model: str) -> DataFrame:
    """Audit row: how many documents of a source could not be read; none if all could."""
    counted = unreadable.agg(row_count().alias("excluded_count")).where("excluded_count > 0")
    return counted.select(
        F.lit(model).alias("model_name"), F.lit("payload is no readable document").alias("exclusion_reason"), "excluded_count"
    )


def excluded_applications(applications_parsed: DataFrame) -> DataFrame:
    """Audit row: how many applications have no submission to put in staging."""
    empty = F.coalesce(F.array_size("submissions"), F.lit(0)) == 0
    return applications_parsed.where(empty).agg(row_count().alias("excluded_count")).select(
        F.lit("stg_approvals").alias("model_name"),
        F.lit("application has no submissions array (empty or null)").alias("exclusion_reason"),
        "excluded_count",
    )
