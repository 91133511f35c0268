"""Frames of the CSV exports. ``cohortline.sinks.csv`` writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import decode_phase, decode_sponsor_class, fill_missing, ratio, round_rates, row_count
from cohortline.operators import lookup
from cohortline.plans import serving


def export_approval_landscape(applicant_years: DataFrame) -> DataFrame:
    return serving.approvals_per_year(applicant_years, "applicant_name", "Unknown").orderBy(
        "approval_year", F.col("approval_count").desc(), "applicant_name"
    )


def export_phase_funnel(condition_funnel: DataFrame) -> DataFrame:
    trials = F.col("trial_count")
    return (
        condition_funnel.where(F.col("condition_name").isNotNull())
        .select(
            "condition_name",
            ratio(F.col("multi_condition_trials"), trials, None).alias("multi_condition_flag_rate"),
            ratio(F.col("matched_trials"), trials, None).alias("matched_to_fda_rate"),
            F.col("condition_phase2_trials").alias("phase2_trials"),
            F.col("condition_phase3_trials").alias("phase3_trials"),
            F.col("condition_approved_trials").alias("approved_trials"),
            "phase2_to_phase3_rate",
            "phase3_to_approval_rate",
            "phase2_to_approval_rate",
        )
        .orderBy(F.col("phase2_trials").desc(), "condition_name")
    )


def export_sponsor_league_table(dim_sponsor: DataFrame) -> DataFrame:
    league = serving.sponsor_league_table(dim_sponsor)
    return league.withColumn("sponsor_class", decode_sponsor_class(F.col("sponsor_class")))


def export_duration_trends(metric_duration_trends: DataFrame) -> DataFrame:
    return serving.duration_trends_overall(metric_duration_trends)


def export_sponsor_cohorts(metric_sponsor_cohorts: DataFrame) -> DataFrame:
    return metric_sponsor_cohorts.drop("cohort_activity_key").orderBy("cohort_year", "activity_year")


def export_termination_reasons(fct_trials: DataFrame, dim_sponsor: DataFrame) -> DataFrame:
    classes = dim_sponsor.select("sponsor_key", "sponsor_class")
    return lookup(fct_trials.where("is_terminated"), classes, "sponsor_key").select(
        decode_phase(F.col("phase")).alias("phase"),
        decode_sponsor_class(F.col("sponsor_class")).alias("sponsor_class"),
        fill_missing(F.col("why_stopped"), "Not Reported").alias("why_stopped"),
        "enrollment_count",
        "start_date",
        "completion_date",
        "duration_days",
    )


def export_phase_distribution(fct_trials: DataFrame) -> DataFrame:
    """Counted per code, then summed per label, since two codes may share a label."""
    coded = (
        fct_trials.where(F.col("start_date").isNotNull())
        .groupBy(F.year("start_date").alias("start_year"), "phase")
        .agg(row_count().alias("n"))
    )
    return (
        coded.groupBy("start_year", decode_phase(F.col("phase")).alias("phase"))
        .agg(F.sum("n").alias("trial_count"))
        .orderBy("start_year", "phase")
    )


def export_pipeline_trust(condition_funnel: DataFrame, dim_condition: DataFrame, fct_trials: DataFrame) -> DataFrame:
    return round_rates(serving.pipeline_trust_scorecard(condition_funnel, dim_condition, fct_trials))
