"""Quality rules: what must hold in the tables, and how many rows break it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions import row_count
from cohortline.operators import orphans

Tables = Callable[[str], DataFrame]

# The rules and the value lists they allow.
NOT_NULL = {
    "raw_studies": ["nct_id"],
    "raw_applications": ["application_number"],
    "stg_trials": ["nct_id", "overall_status", "has_results"],
    "stg_trial_conditions": ["nct_id", "condition_name"],
    "stg_trial_interventions": ["nct_id", "intervention_name", "intervention_type"],
    "stg_sponsors": ["sponsor_name"],
    "stg_approvals": ["approval_key", "application_number", "submission_type", "submission_number"],
    "dim_sponsor": ["sponsor_key", "sponsor_name", "trials_total", "trials_completed", "success_rate"],
    "dim_condition": ["condition_key", "condition_name"],
    "dim_intervention": ["intervention_key", "intervention_name", "intervention_type"],
    "bridge_trial_condition": ["bridge_key", "nct_id", "condition_key"],
    "bridge_trial_intervention": ["bridge_key", "nct_id", "intervention_key"],
    "fct_trials": ["nct_id", "overall_status", "is_terminated", "has_results"],
    "fct_approvals": ["approval_key", "application_number", "submission_type"],
    "metric_phase_transition": [
        "nct_id",
        "grouping_by_condition_name",
        "multi_condition_flag",
        "is_phase2",
        "is_phase3",
        "matched_to_fda",
        "has_fda_approval",
    ],
    "metric_sponsor_cohorts": [
        "cohort_activity_key",
        "cohort_year",
        "activity_year",
        "years_since_cohort",
        "active_sponsor_count",
        "cohort_launch_sponsor_count",
        "survivorship_rate",
    ],
    "metric_duration_trends": [
        "start_year",
        "trial_count",
        "p25_duration_days",
        "median_duration_days",
        "p75_duration_days",
    ],
    "metric_duration_trends_by_phase": [
        "duration_by_phase_key",
        "start_year",
        "phase",
        "trial_count",
        "p25_duration_days",
        "median_duration_days",
        "p75_duration_days",
    ],
}
UNIQUE = {
    "raw_studies": ["nct_id"],
    "raw_applications": ["application_number"],
    "stg_trials": ["nct_id"],
    "stg_sponsors": ["sponsor_name"],
    "stg_approvals": ["approval_key"],
    "dim_sponsor": ["sponsor_key", "sponsor_name"],
    "dim_condition": ["condition_key", "condition_name"],
    "dim_intervention": ["intervention_key"],
    "bridge_trial_condition": ["bridge_key"],
    "bridge_trial_intervention": ["bridge_key"],
    "fct_trials": ["nct_id"],
    "fct_approvals": ["approval_key"],
    "metric_phase_transition": ["nct_id"],
    "metric_sponsor_cohorts": ["cohort_activity_key"],
    "metric_duration_trends": ["start_year"],
    "metric_duration_trends_by_phase": ["duration_by_phase_key"],
}
OVERALL_STATUS = [
    "ACTIVE_NOT_RECRUITING",
    "APPROVED_FOR_MARKETING",
    "AVAILABLE",
    "COMPLETED",
    "ENROLLING_BY_INVITATION",
    "NO_LONGER_AVAILABLE",
    "NOT_YET_RECRUITING",
    "RECRUITING",
    "SUSPENDED",
    "TEMPORARILY_NOT_AVAILABLE",
    "TERMINATED",
    "UNKNOWN",
    "WITHDRAWN",
    "WITHHELD",
]
SPONSOR_CLASS = ["AMBIG", "FED", "INDIV", "INDUSTRY", "NETWORK", "NIH", "OTHER", "OTHER_GOV", "UNKNOWN"]
INTERVENTION_TYPE = [
    "DRUG",
    "DEVICE",
    "BIOLOGICAL",
    "PROCEDURE",
    "BEHAVIORAL",
    "DIETARY_SUPPLEMENT",
    "DIAGNOSTIC_TEST",
    "RADIATION",
    "GENETIC",
    "COMBINATION_PRODUCT",
    "OTHER",
]
SUBMISSION_TYPE = ["ORIG", "SUPPL"]
SUBMISSION_STATUS = ["AP", "TA"]
ACCEPTED = {
    "stg_trials": {"overall_status": OVERALL_STATUS, "sponsor_class": SPONSOR_CLASS},
    "stg_trial_interventions": {"intervention_type": INTERVENTION_TYPE},
    "stg_sponsors": {"sponsor_class": SPONSOR_CLASS},
    "stg_approvals": {"submission_type": SUBMISSION_TYPE, "submission_status": SUBMISSION_STATUS},
    "dim_sponsor": {"sponsor_class": SPONSOR_CLASS},
    "dim_intervention": {"intervention_type": INTERVENTION_TYPE},
    "fct_approvals": {"submission_type": SUBMISSION_TYPE},
    "metric_phase_transition": {"grouping_by_condition_name": [True]},
}
RELATIONSHIPS = [
    ("stg_trials", "sponsor_name", "stg_sponsors", "sponsor_name"),
    ("stg_trial_conditions", "nct_id", "stg_trials", "nct_id"),
    ("stg_trial_interventions", "nct_id", "stg_trials", "nct_id"),
    ("bridge_trial_condition", "nct_id", "fct_trials", "nct_id"),
    ("bridge_trial_condition", "condition_key", "dim_condition", "condition_key"),
    ("bridge_trial_intervention", "nct_id", "fct_trials", "nct_id"),
    ("bridge_trial_intervention", "intervention_key", "dim_intervention", "intervention_key"),
    ("fct_trials", "nct_id", "stg_trials", "nct_id"),
    ("fct_trials", "sponsor_key", "dim_sponsor", "sponsor_key"),
    ("metric_phase_transition", "condition_key", "dim_condition", "condition_key"),
]


def _stacked(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rule_row(model: str, column: str, rule: str, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit(rule).alias("rule"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def count_breaches(frame: DataFrame, model: str, rule: str, breaches: dict[str, Column]) -> DataFrame:
    """Rows on which each condition holds, all conditions in one pass over the table."""
    counts = frame.agg(*(F.count_if(breach).alias(column) for column, breach in breaches.items()))
    return counts.select(F.inline(F.array(*(_rule_row(model, c, rule, F.col(c)) for c in breaches))))


def not_null(tables: Tables, rules: dict[str, list[str]] = NOT_NULL) -> DataFrame:
    """Rows with a NULL."""
    return _stacked(
        count_breaches(tables(model), model, "not_null", {c: F.col(c).isNull() for c in columns})
        for model, columns in rules.items()
    )


def accepted_values(tables: Tables, rules: dict[str, dict[str, list]] = ACCEPTED) -> DataFrame:
    """Rows with a value outside the list; NULL is a matter of ``not_null``."""
    return _stacked(
        count_breaches(
            tables(model), model, "accepted_values", {c: ~F.col(c).isin(*allowed) for c, allowed in lists.items()}
        )
        for model, lists in rules.items()
    )


def unique(tables: Tables, rules: dict[str, list[str]] = UNIQUE) -> DataFrame:
    """Values occurring more than once.

    Every table is read once and gives one row per value and rule, told apart as text; all
    of them are counted in one aggregation, hence one exchange for all tables and columns.
    """
    columns = [(model, column) for model, names in rules.items() for column in names]

    def values(model: str, names: list[str]) -> DataFrame:
        cells = (
            F.struct(F.lit(columns.index((model, name))).alias("_rule"), F.col(name).cast("string").alias("_value"))
            for name in names
        )
        return tables(model).select(F.inline(F.array(*cells))).where(F.col("_value").isNotNull())

    counted = _stacked(values(model, names) for model, names in rules.items())
    repeated = counted.groupBy("_rule", "_value").agg(row_count().alias("_n")).where("_n > 1")
    totals = repeated.agg(*(F.count_if(F.col("_rule") == k).alias(f"_{k}") for k in range(len(columns))))
    return totals.select(
        F.inline(F.array(*(_rule_row(m, c, "unique", F.col(f"_{k}")) for k, (m, c) in enumerate(columns))))
    )


def relationships(tables: Tables, rules: list[tuple[str, str, str, str]] = RELATIONSHIPS) -> DataFrame:
    """Rows whose key is missing in the parent."""

    def missing(child: str, key: str, parent: str, parent_key: str) -> DataFrame:
        lost = orphans(tables(child), key, tables(parent).select(parent_key), parent_key)
        return lost.agg(F.sum("child_rows").alias("_rows")).select(
            F.inline(F.array(_rule_row(child, key, "relationships", F.col("_rows"))))
        )

    return _stacked(missing(*rule) for rule in rules)


def report(tables: Tables) -> DataFrame:
    """Every rule with its number of failures."""
    return _stacked(check(tables) for check in (not_null, unique, accepted_values, relationships))


class QualityError(RuntimeError):
    pass


def require_clean(rules: DataFrame) -> None:
    """Raise if a rule has failures. The report has one row per rule."""
    broken = rules.where("failures > 0").collect()
    if broken:
        lines = (f"{r.rule} on {r.model}.{r.column_name}: {r.failures}" for r in broken)
        raise QualityError("; ".join(lines))


def nonempty(tables: Tables, names: Iterable[str] = ("raw_studies", "raw_applications")) -> DataFrame:
    """Which tables hold a row; at most one row of each is read."""

    def check(name: str) -> DataFrame:
        first = tables(name).select(F.lit(1)).limit(1)
        return first.agg(F.lit(name).alias("source"), (row_count() > 0).alias("has_rows"))

    return _stacked(check(name) for name in names)


def require_nonempty(tables: Tables, names: Iterable[str] = ("raw_studies", "raw_applications")) -> None:
    empty = [row.source for row in nonempty(tables, names).where("not has_rows").collect()]
    if empty:
        raise QualityError(f"no rows in {', '.join(empty)}")


WARN_HOURS, ERROR_HOURS = 26, 50


def freshness(tables: Tables, as_of: Column, names: Iterable[str] = ("raw_studies", "raw_applications")) -> DataFrame:
    """Age of the newest record per source: pass, warn above 26 hours, error above 50."""

    def check(name: str) -> DataFrame:
        newest = tables(name).agg(F.max("fetched_at").alias("newest"))
        hours = (F.unix_timestamp(as_of) - F.unix_timestamp("newest")) / 3600.0
        status = (
            F.when(F.col("newest").isNull() | (hours > ERROR_HOURS), "error")
            .when(hours > WARN_HOURS, "warn")
            .otherwise("pass")
        )
        return newest.select(
            F.lit(name).alias("source"), hours.cast("double").alias("age_hours"), status.alias("status")
        )

    return _stacked(check(name) for name in names)
