"""Metrics, and the small tables they share.

The shared tables hold one row per sponsor, condition or (year, phase, day
count). They are written once, which gives later joins a measured size and keeps
the trial-level data from being aggregated more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import is_combined_phase, normalized_name, ratio, row_count, surrogate_key
from cohortline.operators import (
    active_spans,
    add_lag,
    add_launch_value,
    count_by_year,
    lookup_with_null,
    match_by_name,
    percentile_bands,
    value_histogram,
)

BANDS = {"p25_duration_days": 0.25, "median_duration_days": 0.5, "p75_duration_days": 0.75}


# Shared tables


def application_status(applications_parsed: DataFrame) -> DataFrame:
    """One row per application with submissions: approved or not, and since when.

    Same result as collapsing the submission events, but read off each document,
    where all events of an application already are.
    """
    approved = F.filter("submissions", lambda s: s["submission_status"] == "AP")
    status = F.struct(
        F.array_max(F.transform("submissions", lambda s: s["submission_status"] == "AP")).alias("is_approved"),
        F.array_min(F.transform(approved, lambda s: s["submission_status_date"])).alias("first_approval_date"),
    )
    # Exploded and not filtered: the optimizer would read the submissions out of the document for the filter once more.
    told = F.explode(F.when(F.array_size("submissions") > 0, F.array(status)))
    return applications_parsed.select("application_number", "sponsor_name", told.alias("_status")).select(
        "application_number", "sponsor_name", "_status.is_approved", "_status.first_approval_date"
    )


def applicant_years(application_status: DataFrame) -> DataFrame:
    """Applications first approved, per year and applicant."""
    approved = application_status.where(F.col("is_approved") & F.col("first_approval_date").isNotNull())
    return approved.groupBy(F.year("first_approval_date").alias("approval_year"), "sponsor_name").agg(
        row_count().alias("approval_count")
    )


def fda_sponsors(application_status: DataFrame) -> DataFrame:
    """Applicants under their normalized name. An application is one row of the input."""
    return (
        application_status.where(F.col("sponsor_name").isNotNull())
        .groupBy(normalized_name(F.col("sponsor_name")).alias("sponsor_name_norm"))
        .agg(
            row_count().alias("fda_application_count"),
            F.bool_or("is_approved").alias("has_fda_approval"),
        )
    )


def trial_stages(studies_parsed: DataFrame) -> DataFrame:
    """One row per trial with its representative condition and stages, as its document tells them.

    The representative is the condition with the smallest key. It is picked inside
    the row, because a document lists all conditions of its trial.
    """
    keyed = F.transform(
        "conditions", lambda name: F.struct(surrogate_key(name).alias("key"), name.alias("name"))
    )
    trials = studies_parsed.select(
        "nct_id",
        F.array_min(keyed).alias("first"),
        F.coalesce(F.array_size("conditions") > 1, F.lit(False)).alias("multi_condition_flag"),
        "phase",
        "sponsor_name",
    )
    return trials.select(
        "nct_id",
        F.col("first.key").alias("condition_key"),
        F.col("first.name").alias("condition_name"),
        F.lit(None).cast("string").alias("therapeutic_area"),
        F.lit(True).alias("grouping_by_condition_name"),
        "multi_condition_flag",
        "phase",
        is_combined_phase(F.col("phase"), "PHASE2").alias("is_phase2"),
        is_combined_phase(F.col("phase"), "PHASE3").alias("is_phase3"),
        "sponsor_name",
    )


def with_applicants(trial_stages: DataFrame, fda_sponsors: DataFrame) -> DataFrame:
    """The trials with the match of their sponsor among the applicants."""
    approvals = fda_sponsors.select("sponsor_name_norm", "has_fda_approval")
    return match_by_name(trial_stages, approvals, "sponsor_name", "sponsor_name_norm").select(
        *trial_stages.columns,
        F.col("matched").alias("matched_to_fda"),
        F.coalesce("has_fda_approval", F.lit(False)).alias("has_fda_approval"),
    )


def trial_funnel(studies_parsed: DataFrame, fda_sponsors: DataFrame) -> DataFrame:
    """One row per trial with its representative condition, stages and applicant match."""
    return with_applicants(trial_stages(studies_parsed), fda_sponsors)


def with_rates(volumes: DataFrame) -> DataFrame:
    """Stage volumes with their ratios."""
    phase2, phase3 = F.col("condition_phase2_trials"), F.col("condition_phase3_trials")
    approved = F.col("condition_approved_trials")
    return volumes.select(
        "*",
        ratio(phase3, phase2).alias("phase2_to_phase3_rate"),
        ratio(approved, phase3).alias("phase3_to_approval_rate"),
        ratio(approved, phase2).alias("phase2_to_approval_rate"),
    )


def condition_funnel(trial_funnel: DataFrame) -> DataFrame:
    """Stage volumes and their ratios per representative condition, NULL included."""
    return with_rates(
        trial_funnel.groupBy("condition_name").agg(
            row_count().alias("trial_count"),
            F.count_if("multi_condition_flag").alias("multi_condition_trials"),
            F.count_if("matched_to_fda").alias("matched_trials"),
            F.count_if("is_phase2").alias("condition_phase2_trials"),
            F.count_if("is_phase3").alias("condition_phase3_trials"),
            F.count_if(F.col("matched_to_fda") & F.col("has_fda_approval")).alias("condition_approved_trials"),
        )
    )


def duration_histogram(fct_trials: DataFrame) -> DataFrame:
    """How many trials lasted how many days, per start year and phase."""
    measured = fct_trials.where(F.col("duration_days").isNotNull() & F.col("start_date").isNotNull())
    return value_histogram(
        measured.select(F.year("start_date").alias("start_year"), "phase", "duration_days"),
        ["start_year", "phase"],
        "duration_days",
    )


def sponsor_activity(fct_trials: DataFrame) -> DataFrame:
    """Per sponsor the year of the first trial and the disjoint spans of years with one running."""
    spans = active_spans(fct_trials, "sponsor_key", "start_date", "completion_date")
    return spans.withColumnRenamed("first_year", "cohort_year")


# Metrics


def metric_phase_transition(trial_funnel: DataFrame, condition_funnel: DataFrame) -> DataFrame:
    """The trial rows with the stage volumes of their condition on each."""
    volumes = condition_funnel.drop("trial_count", "multi_condition_trials", "matched_trials")
    return lookup_with_null(trial_funnel, volumes, "condition_name")


def metric_sponsor_cohorts(sponsor_activity: DataFrame, dim_sponsor: DataFrame) -> DataFrame:
    counted = count_by_year(sponsor_activity, "cohort_year", "spans", "activity_year", "active_sponsor_count")
    # One row per sponsor on both sides, so no key can be hot.
    members = sponsor_activity.select("sponsor_key", "cohort_year").join(dim_sponsor, "sponsor_key")
    # Rates have four digits; averaging them as decimals keeps ties exact.
    mean_rate = F.sum(F.col("success_rate").cast("decimal(5,4)")) / row_count()
    cohorts = members.groupBy("cohort_year").agg(
        row_count().alias("cohort_sponsor_count"),
        F.sum("trials_total").alias("cohort_total_trials"),
        F.sum("trials_completed").alias("cohort_total_completed"),
        F.round(mean_rate, 4).cast("double").alias("cohort_avg_success_rate"),
    )
    curve = add_launch_value(
        counted, "cohort_launch_sponsor_count", "active_sponsor_count", "cohort_year", "activity_year"
    )
    return curve.join(cohorts, "cohort_year", "left").select(
        surrogate_key("cohort_year", "activity_year").alias("cohort_activity_key"),
        "cohort_year",
        "activity_year",
        (F.col("activity_year") - F.col("cohort_year")).alias("years_since_cohort"),
        "active_sponsor_count",
        "cohort_launch_sponsor_count",
        ratio(F.col("active_sponsor_count"), F.col("cohort_launch_sponsor_count")).alias("survivorship_rate"),
        "cohort_sponsor_count",
        "cohort_total_trials",
        "cohort_total_completed",
        "cohort_avg_success_rate",
    )


def _year_over_year(bands: DataFrame, *partition: str) -> DataFrame:
    """Change against the previous existing year, from unrounded medians."""
    before, median = F.col("_before"), F.col("median_duration_days")
    change = median - before
    return add_lag(bands, "_before", "median_duration_days", "start_year", *partition).select(
        *bands.columns,
        before.alias("prior_year_median_duration_days"),
        change.alias("yoy_change_days"),
        F.round(change * 100 / F.nullif(before, F.lit(0)), 2).alias("yoy_change_pct"),
    )


def _rounded_days(frame: DataFrame) -> list:
    days = [*BANDS, "prior_year_median_duration_days", "yoy_change_days"]
    return [F.round(name, 1).alias(name) for name in days]


def metric_duration_trends(duration_histogram: DataFrame) -> DataFrame:
    bands = percentile_bands(duration_histogram, ["start_year"], "duration_days", BANDS)
    series = _year_over_year(bands)
    return series.select("start_year", "trial_count", *_rounded_days(series), "yoy_change_pct")


def metric_duration_trends_by_phase(duration_histogram: DataFrame) -> DataFrame:
    phased = duration_histogram.where(F.col("phase").isNotNull())
    bands = percentile_bands(phased, ["start_year", "phase"], "duration_days", BANDS)
    series = _year_over_year(bands, "phase")
    return series.select(
        surrogate_key("start_year", "phase").alias("duration_by_phase_key"),
        "start_year",
        "phase",
        "trial_count",
        *_rounded_days(series),
    )
