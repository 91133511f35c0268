"""Serving queries: what a dashboard asks for, as small DataFrames.

Approval queries read ``application_status``, which is one row per application;
``cohortline.operators.approval_by_application`` gives the same table from the
submission events of ``fct_approvals``. Funnel queries read ``condition_funnel``,
which holds the distinct conditions of ``metric_phase_transition``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions import fill_missing, rate, ratio, row_count
from cohortline.operators import one_row, top_k

FUNNEL_COLUMNS = [
    "condition_name",
    "condition_phase2_trials",
    "condition_phase3_trials",
    "condition_approved_trials",
    "phase2_to_phase3_rate",
    "phase3_to_approval_rate",
    "phase2_to_approval_rate",
]


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """A user's own SQL over the published tables."""
    return spark.sql(sql)


def approvals_per_year(applicant_years: DataFrame, name: str, missing: str) -> DataFrame:
    """Counts under the shown name; applicants without a name join those so called."""
    return applicant_years.groupBy("approval_year", fill_missing(F.col("sponsor_name"), missing).alias(name)).agg(
        F.sum("approval_count").alias("approval_count")
    )


def approvals_by_sponsor_class_year(applicant_years: DataFrame) -> DataFrame:
    return approvals_per_year(applicant_years, "sponsor_name", "UNKNOWN").orderBy(
        "approval_year", "sponsor_name"
    )


def top_sponsors_by_approval_count(application_status: DataFrame, limit: int = 20) -> DataFrame:
    counts = (
        application_status.where("is_approved")
        .groupBy(fill_missing(F.col("sponsor_name"), "UNKNOWN").alias("sponsor_name"))
        .agg(row_count().alias("approval_count"))
    )
    return top_k(counts, limit, F.col("approval_count").desc(), F.col("sponsor_name"))


def phase_funnel_by_condition(condition_funnel: DataFrame, min_phase2_trials: int = 50) -> DataFrame:
    shown = condition_funnel.where(F.col("condition_phase2_trials") >= min_phase2_trials)
    return shown.select(*FUNNEL_COLUMNS).orderBy(F.col("condition_phase2_trials").desc(), "condition_name")


def phase_funnel_audit_metrics(condition_funnel: DataFrame) -> DataFrame:
    """Flag rates over all trials, from the per-condition counts."""
    trials = F.sum("trial_count")
    return condition_funnel.agg(
        ratio(F.sum("multi_condition_trials"), trials, None).alias("multi_condition_flag_rate"),
        ratio(F.sum("matched_trials"), trials, None).alias("matched_to_fda_rate"),
        F.coalesce(trials, F.lit(0)).alias("trial_count"),
    )


def sponsor_league_table(dim_sponsor: DataFrame) -> DataFrame:
    return dim_sponsor.select(
        "sponsor_name", "sponsor_class", "trials_total", "trials_completed", "success_rate"
    ).orderBy(F.col("trials_total").desc(), "sponsor_name")


def duration_trends_overall(metric_duration_trends: DataFrame) -> DataFrame:
    return metric_duration_trends.drop("prior_year_median_duration_days").orderBy("start_year")


def duration_trends_by_phase(metric_duration_trends_by_phase: DataFrame) -> DataFrame:
    return metric_duration_trends_by_phase.drop(
        "duration_by_phase_key", "prior_year_median_duration_days"
    ).orderBy("phase", "start_year")


def sponsor_cohort_survivorship(metric_sponsor_cohorts: DataFrame) -> DataFrame:
    return metric_sponsor_cohorts.select(
        "cohort_year",
        "activity_year",
        "years_since_cohort",
        "active_sponsor_count",
        "cohort_launch_sponsor_count",
        "survivorship_rate",
    ).orderBy("cohort_year", "activity_year")


def _termination_rate(trials: DataFrame, group: str, missing: str) -> DataFrame:
    terminated = F.count_if("is_terminated")
    return (
        trials.groupBy(fill_missing(F.col(group), missing).alias(group))
        .agg(
            row_count().alias("trial_count"),
            terminated.alias("terminated_count"),
            ratio(terminated, row_count()).alias("termination_rate"),
        )
        .orderBy(F.col("termination_rate").desc(), group)
    )


def termination_rate_by_phase(fct_trials: DataFrame) -> DataFrame:
    return _termination_rate(fct_trials, "phase", "NOT REPORTED")


def termination_rate_by_sponsor_class(fct_trials: DataFrame, dim_sponsor: DataFrame) -> DataFrame:
    """Trials are counted per sponsor first, so a sponsor is joined once, however many it has."""
    per_sponsor = fct_trials.groupBy("sponsor_key").agg(
        row_count().alias("trials"), F.count_if("is_terminated").alias("terminated")
    )
    classes = dim_sponsor.select("sponsor_key", "sponsor_class")
    return (
        per_sponsor.join(classes, "sponsor_key", "left")
        .groupBy(fill_missing(F.col("sponsor_class"), "UNKNOWN").alias("sponsor_class"))
        .agg(
            F.sum("trials").alias("trial_count"),
            F.sum("terminated").alias("terminated_count"),
            ratio(F.sum("terminated"), F.sum("trials")).alias("termination_rate"),
        )
        .orderBy(F.col("termination_rate").desc(), "sponsor_class")
    )


def why_stopped_breakdown(fct_trials: DataFrame, limit: int = 15) -> DataFrame:
    reasons = (
        fct_trials.where(F.col("why_stopped").isNotNull())
        .groupBy("why_stopped")
        .agg(row_count().alias("trial_count"))
    )
    return top_k(reasons, limit, F.col("trial_count").desc(), F.col("why_stopped"))


def why_stopped_coverage(fct_trials: DataFrame) -> DataFrame:
    return fct_trials.agg(
        F.count_if("is_terminated").alias("terminated_trials"),
        F.count_if(F.col("is_terminated") & F.col("why_stopped").isNotNull()).alias("terminated_with_reason"),
    )


def trials_per_phase_year(fct_trials: DataFrame) -> DataFrame:
    return (
        fct_trials.where(F.col("start_date").isNotNull())
        .groupBy(
            F.year("start_date").alias("start_year"),
            fill_missing(F.col("phase"), "NOT REPORTED").alias("phase"),
        )
        .agg(row_count().alias("trial_count"))
    )


def phase_distribution_by_year(fct_trials: DataFrame) -> DataFrame:
    return trials_per_phase_year(fct_trials).orderBy("start_year", "phase")


def pipeline_trust_scorecard(condition_funnel: DataFrame, dim_condition: DataFrame, fct_trials: DataFrame) -> DataFrame:
    """Known limits of the data as one row: four rates and the grouping flag."""
    flags = phase_funnel_audit_metrics(condition_funnel).select(
        "multi_condition_flag_rate",
        "matched_to_fda_rate",
        F.when(F.col("trial_count") > 0, F.lit(True)).alias("grouping_by_condition_name"),
    )
    areas = dim_condition.agg(rate(F.col("therapeutic_area").isNull()).alias("therapeutic_area_null_rate"))
    ends = fct_trials.agg(rate(F.col("completion_date").isNull()).alias("completion_date_null_rate"))
    return one_row(flags, areas, ends)
