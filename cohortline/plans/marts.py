"""Marts: the star schema.

Keys are digests of names, and every name in a fact or bridge comes from the
same documents as the dimension. A key is therefore computed where it is needed
and not looked up: the inner and left joins that a lookup would take cannot add
or drop a row, apart from the NULL intervention types an inner join drops, which
are filtered. Facts and bridges are row-local as a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import days_between, ratio, row_count, surrogate_key
from cohortline.operators import mode_per_group


def dim_sponsor(stg_trials: DataFrame) -> DataFrame:
    """Mode of the class and trial counts from one pair of aggregations."""
    named = stg_trials.where(F.col("sponsor_name").isNotNull())
    sponsors = mode_per_group(
        named,
        "sponsor_name",
        "sponsor_class",
        trials_total=row_count(),
        trials_completed=F.count_if(F.col("overall_status") == "COMPLETED"),
    )
    return sponsors.select(
        surrogate_key("sponsor_name").alias("sponsor_key"),
        "sponsor_name",
        "sponsor_class",
        "trials_total",
        "trials_completed",
        ratio(F.col("trials_completed"), F.col("trials_total")).alias("success_rate"),
    )


def dim_condition(stg_trial_conditions: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return (
        stg_trial_conditions.select("condition_name")
        .distinct()
        .select(
            surrogate_key("condition_name").alias("condition_key"),
            "condition_name",
            nothing.alias("mesh_term"),
            nothing.alias("therapeutic_area"),
        )
    )


def dim_intervention(stg_trial_interventions: DataFrame) -> DataFrame:
    return (
        stg_trial_interventions.select("intervention_name", "intervention_type")
        .distinct()
        .select(
            surrogate_key("intervention_name", "intervention_type").alias("intervention_key"),
            "intervention_name",
            "intervention_type",
        )
    )


def bridge_trial_condition(stg_trial_conditions: DataFrame) -> DataFrame:
    keyed = stg_trial_conditions.select("nct_id", surrogate_key("condition_name").alias("condition_key"))
    return keyed.select(surrogate_key("nct_id", "condition_key").alias("bridge_key"), "nct_id", "condition_key")


def bridge_trial_intervention(stg_trial_interventions: DataFrame) -> DataFrame:
    keyed = stg_trial_interventions.where(F.col("intervention_type").isNotNull()).select(
        "nct_id", surrogate_key("intervention_name", "intervention_type").alias("intervention_key")
    )
    return keyed.select(
        surrogate_key("nct_id", "intervention_key").alias("bridge_key"), "nct_id", "intervention_key"
    )


def fct_trials(stg_trials: DataFrame) -> DataFrame:
    name = F.col("sponsor_name")
    return stg_trials.select(
        "nct_id",
        F.when(name.isNotNull(), surrogate_key(name)).alias("sponsor_key"),
        "phase",
        "overall_status",
        "enrollment_count",
        "start_date",
        "completion_date",
        days_between(F.col("start_date"), F.col("completion_date")).alias("duration_days"),
        (F.col("overall_status") == "TERMINATED").alias("is_terminated"),
        "why_stopped",
        "has_results",
        "num_primary_outcomes",
        "num_sites",
    )


def fct_approvals(stg_approvals: DataFrame) -> DataFrame:
    return stg_approvals.select(
        "approval_key",
        "application_number",
        "sponsor_name",
        "submission_type",
        "submission_status",
        F.col("submission_status_date").alias("approval_date"),
        "review_priority",
    )
