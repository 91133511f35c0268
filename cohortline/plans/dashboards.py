"""Derivations a dashboard page makes from the serving queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions import ratio, row_count, traffic_light
from cohortline.operators import add_share, number_rows, rows_of_top_members, split_at, top_k
from cohortline.plans import serving
from cohortline.workspace import Workspace

# Cutoffs, default selections and thresholds of the dashboards.
CENSOR_CUTOFF = 2017
FUNNEL_MIN_PHASE2 = 100
DEFAULT_PHASES = ("PHASE1", "PHASE2", "PHASE3", "PHASE4")
DEFAULT_COHORTS = (2000, 2005, 2010, 2015, 2020)
YEAR_WINDOW = (1990, 2024)
GOOD_MAX, WARNING_MAX = 0.15, 0.35
TOP_MARK = "🏆"


def approvals_yearly_total(applicant_years: DataFrame) -> DataFrame:
    by_year = serving.approvals_per_year(applicant_years, "sponsor_name", "UNKNOWN")
    return by_year.groupBy("approval_year").agg(F.sum("approval_count").alias("approval_count"))


def approvals_top10_series(applicant_years: DataFrame, members: int = 10) -> DataFrame:
    by_year = serving.approvals_per_year(applicant_years, "sponsor_name", "UNKNOWN")
    leaders = rows_of_top_members(by_year, "sponsor_name", "approval_count", members)
    return leaders.orderBy("approval_year", "sponsor_name")


def funnel_over_100_counts(condition_funnel: DataFrame, min_phase2_trials: int = FUNNEL_MIN_PHASE2) -> DataFrame:
    """How many of the conditions shown have a ratio above one."""
    shown = condition_funnel.where(F.col("condition_phase2_trials") >= min_phase2_trials)
    over_phase3 = F.count_if(F.col("phase2_to_phase3_rate") > 1)
    over_approval = F.count_if(F.col("phase3_to_approval_rate") > 1)
    count = row_count()
    return shown.agg(
        count.alias("conditions_shown"),
        over_phase3.alias("over_100_phase3"),
        ratio(over_phase3, count, None).alias("over_100_phase3_share"),
        over_approval.alias("over_100_approval"),
        ratio(over_approval, count, None).alias("over_100_approval_share"),
    )


def funnel_top_n(
    condition_funnel: DataFrame, n: int = 15, min_phase2_trials: int = FUNNEL_MIN_PHASE2
) -> DataFrame:
    shown = condition_funnel.where(F.col("condition_phase2_trials") >= min_phase2_trials)
    return top_k(
        shown.select(*serving.FUNNEL_COLUMNS), n, F.col("condition_phase2_trials").desc(), F.col("condition_name")
    )


def league_ranked(dim_sponsor: DataFrame, workspace: Workspace, classes: Sequence[str] | None = None) -> DataFrame:
    """League table with positions.

    The page starts with all classes chosen, which leaves out sponsors without one; an
    emptied selection shows everyone.
    """
    league = dim_sponsor.select(
        "sponsor_name", "sponsor_class", "trials_total", "trials_completed", "success_rate"
    )
    if classes is None:
        league = league.where("sponsor_class is not null")
    elif classes:
        league = league.where(F.col("sponsor_class").isin(*classes))
    ranked = number_rows(league, "rank", workspace, F.col("trials_total").desc(), F.col("sponsor_name").asc())
    mark = F.when(F.col("rank") <= 10, F.lit(TOP_MARK)).otherwise(F.lit(""))
    return ranked.select("rank", mark.alias("top_10"), *league.columns)


def duration_censor_split(metric_duration_trends: DataFrame, cutoff: int = CENSOR_CUTOFF) -> DataFrame:
    return split_at(serving.duration_trends_overall(metric_duration_trends), "start_year", cutoff)


def duration_phase_series_truncated(
    metric_duration_trends_by_phase: DataFrame,
    phases: Sequence[str] | None = None,
    cutoff: int = CENSOR_CUTOFF,
) -> DataFrame:
    """Series of the chosen phases up to the cutoff: by default the four phases that exist,
    else the first four labels; no phase chosen, no row."""
    series = serving.duration_trends_by_phase(metric_duration_trends_by_phase)
    if phases is None:
        # Labels are few; the windows run over one row each.
        preferred = F.col("phase").isin(*DEFAULT_PHASES)
        known = series.select("phase").distinct().select(
            "phase",
            preferred.alias("preferred"),
            F.max(preferred).over(Window.partitionBy()).alias("any"),
            F.row_number().over(Window.orderBy("phase")).alias("n"),
        )
        series = series.join(known.where("preferred or (not any and n <= 4)").select("phase"), "phase", "left_semi")
    else:
        series = series.where(F.col("phase").isin(*phases) if phases else F.lit(False))
    return series.where(F.col("start_year") <= cutoff).select(
        "phase", "start_year", "median_duration_days"
    )


def cohort_compare(
    metric_sponsor_cohorts: DataFrame, cohorts: Sequence[int] | None = None, measure: str = "survivorship_rate"
) -> DataFrame:
    """Curves of the chosen cohorts: the default years that exist, else the first five."""
    curves = serving.sponsor_cohort_survivorship(metric_sponsor_cohorts)
    if cohorts is None:
        years = curves.select("cohort_year").distinct()
        preferred = F.col("cohort_year").isin(*DEFAULT_COHORTS)
        any_preferred = F.max(preferred).over(Window.partitionBy())
        position = F.row_number().over(Window.orderBy("cohort_year"))
        chosen = years.select(
            "cohort_year", preferred.alias("preferred"), any_preferred.alias("any"), position.alias("n")
        ).where("preferred or (not any and n <= 5)")
        curves = curves.join(chosen.select("cohort_year"), "cohort_year", "left_semi")
    else:
        curves = curves.where(F.col("cohort_year").isin(*cohorts) if cohorts else F.lit(False))
    return curves.select("cohort_year", "years_since_cohort", F.col(measure).alias("value"))


def why_stopped_share(fct_trials: DataFrame) -> DataFrame:
    share = ratio(F.col("terminated_with_reason"), F.col("terminated_trials"), None)
    return serving.why_stopped_coverage(fct_trials).withColumn("reason_share", share)


def phase_share_by_year(
    fct_trials: DataFrame, window: tuple[int, int] = YEAR_WINDOW, as_share: bool = True
) -> DataFrame:
    """Phase mix per year; the share is taken within the chosen years."""
    counts = serving.trials_per_phase_year(fct_trials).where(F.col("start_year").between(*window))
    if as_share:
        valued = add_share(counts, "value", "trial_count", "start_year")
    else:
        valued = counts.withColumn("value", F.col("trial_count").cast("double"))
    return valued.orderBy("start_year", "phase")


def trust_lights(scorecard: DataFrame) -> DataFrame:
    """Colour per scorecard entry. A high match rate is good, so its light is inverted."""

    def light(value):
        return traffic_light(value, GOOD_MAX, WARNING_MAX)

    return scorecard.select(
        light(F.col("multi_condition_flag_rate")).alias("multi_condition_light"),
        light(1 - F.col("matched_to_fda_rate")).alias("fda_match_light"),
        F.when(F.col("grouping_by_condition_name"), "amber").otherwise("green").alias("grouping_light"),
        F.lit("amber").alias("therapeutic_area_light"),
        light(F.col("completion_date_null_rate")).alias("completion_date_light"),
    )
