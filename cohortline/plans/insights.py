"""Analysis queries and KPI definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import ratio, row_count
from cohortline.operators import add_share, split_at, top_k, with_summary
from cohortline.plans.dashboards import CENSOR_CUTOFF


def insight_phase2_band(condition_funnel: DataFrame, min_phase2_trials: int = 100, k: int = 15) -> DataFrame:
    """Top conditions with a phase-3 ratio of at most one, beside how many exceed it and the extremes."""
    shown = condition_funnel.where(F.col("condition_phase2_trials") >= min_phase2_trials).select(
        "condition_name", "condition_phase2_trials", "phase2_to_phase3_rate"
    )
    in_band = F.col("phase2_to_phase3_rate") <= 1
    place = F.when(
        in_band,
        F.struct(
            -F.col("phase2_to_phase3_rate"),
            F.coalesce("condition_name", F.lit("")).alias("place"),
            F.col("condition_name").alias("name"),
        ),
    )
    summary = shown.agg(
        F.count_if(F.col("phase2_to_phase3_rate") > 1).alias("over_count"),
        row_count().alias("total_count"),
        F.min(place)["name"].alias("highest_condition"),
        F.max(place)["name"].alias("lowest_condition"),
    )
    return top_k(
        with_summary(shown.where(in_band), summary),
        k,
        F.col("phase2_to_phase3_rate").desc(),
        F.col("condition_name").asc_nulls_first(),
    )


def insight_approval_noise(condition_funnel: DataFrame, min_phase3_trials: int = 5, k: int = 15) -> DataFrame:
    """Top approval ratios, beside how many named conditions exceed one."""
    shown = condition_funnel.where(F.col("condition_phase3_trials") >= min_phase3_trials)
    named = F.col("condition_name").isNotNull()
    summary = shown.agg(
        F.count_if(named & (F.col("phase3_to_approval_rate") > 1)).alias("over_count"),
        F.count_if(named).alias("total_count"),
    )
    rates = shown.select("condition_name", "condition_phase3_trials", "phase3_to_approval_rate")
    return top_k(
        with_summary(rates, summary),
        k,
        F.col("phase3_to_approval_rate").desc(),
        F.col("condition_name").asc_nulls_first(),
    )


def insight_fda_coverage(metric_phase_transition: DataFrame) -> DataFrame:
    """Two rows; the window over them holds no more."""
    counts = metric_phase_transition.groupBy("matched_to_fda").agg(row_count().alias("trial_count"))
    return add_share(counts, "share", "trial_count")


def _value_at(frame: DataFrame, key: str, at: dict[int, str], value: str) -> DataFrame:
    """One row holding a series' value at given points, NULL where it has none."""
    return frame.agg(*(F.max(F.when(F.col(key) == point, F.col(value))).alias(name) for point, name in at.items()))


def insight_cohort_2010(metric_sponsor_cohorts: DataFrame, cohort_year: int = 2010, years: int = 15) -> DataFrame:
    curve = metric_sponsor_cohorts.where(
        (F.col("cohort_year") == cohort_year) & (F.col("years_since_cohort") <= years)
    ).select("years_since_cohort", "survivorship_rate")
    points = _value_at(curve, "years_since_cohort", {5: "rate_after_5", 10: "rate_after_10"}, "survivorship_rate")
    return with_summary(curve, points)


def insight_survival_5y(metric_sponsor_cohorts: DataFrame, first: int = 2000, last: int = 2019) -> DataFrame:
    return metric_sponsor_cohorts.where(
        (F.col("years_since_cohort") == 5) & F.col("cohort_year").between(first, last)
    ).select("cohort_year", "survivorship_rate")


def insight_volume_growth(metric_duration_trends: DataFrame, first: int = 1990, last: int = 2023) -> DataFrame:
    series = metric_duration_trends.where(F.col("start_year").between(first, last)).select(
        "start_year", "trial_count"
    )
    ends = _value_at(series, "start_year", {1990: "_from", 2020: "_to"}, "trial_count")
    return with_summary(series, ends).select(
        "start_year", "trial_count", ratio(F.col("_to"), F.col("_from"), 1).alias("growth_factor")
    )


def insight_duration_censoring(metric_duration_trends: DataFrame, first: int = 1985, last: int = 2024) -> DataFrame:
    series = metric_duration_trends.where(F.col("start_year").between(first, last)).select(
        "start_year", "median_duration_days"
    )
    points = _value_at(series, "start_year", {1990: "median_1990", 2020: "median_2020"}, "median_duration_days")
    return with_summary(split_at(series, "start_year", CENSOR_CUTOFF), points)


def kpi_phase2_to_phase3(condition_funnel: DataFrame) -> DataFrame:
    return condition_funnel.select("condition_name", "phase2_to_phase3_rate")


def kpi_phase3_to_approval(condition_funnel: DataFrame) -> DataFrame:
    return condition_funnel.select("condition_name", "phase3_to_approval_rate")


def kpi_portfolio_phase2_to_approval(condition_funnel: DataFrame) -> DataFrame:
    """One ratio over all conditions, trials without a condition included."""
    return condition_funnel.agg(
        ratio(F.sum("condition_approved_trials"), F.sum("condition_phase2_trials"), None).alias(
            "phase2_to_approval_rate"
        )
    )


def kpi_sponsor_success(dim_sponsor: DataFrame) -> DataFrame:
    return dim_sponsor.select("sponsor_name", "sponsor_class", "trials_total", "trials_completed", "success_rate")


def kpi_survivorship_10y(metric_sponsor_cohorts: DataFrame) -> DataFrame:
    return metric_sponsor_cohorts.where("years_since_cohort = 10").select("cohort_year", "survivorship_rate")


def kpi_median_duration_yoy(metric_duration_trends: DataFrame) -> DataFrame:
    return metric_duration_trends.select("start_year", "median_duration_days", "yoy_change_pct")


def kpi_termination_rate(fct_trials: DataFrame) -> DataFrame:
    """By phase, unrounded; unlike the dashboard, trials without a phase are left out."""
    terminated = F.count_if("is_terminated")
    return (
        fct_trials.where(F.col("phase").isNotNull())
        .groupBy("phase")
        .agg(
            terminated.alias("terminated_trials"),
            row_count().alias("total_trials"),
            ratio(terminated, row_count(), None).alias("termination_rate"),
        )
    )


def kpi_approval_events_by_year(fct_approvals: DataFrame) -> DataFrame:
    """Counts submission events; the dashboard counts applications."""
    return (
        fct_approvals.where((F.col("submission_status") == "AP") & F.col("approval_date").isNotNull())
        .groupBy(F.year("approval_date").alias("approval_year"))
        .agg(row_count().alias("approval_count"))
        .orderBy("approval_year")
    )
