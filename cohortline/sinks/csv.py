from __future__ import annotations

from pyspark.sql import DataFrame

from cohortline.plans import exports
from cohortline.warehouse import Warehouse

# Exports with a row per year, phase or cohort at most: one file each. The others
# grow with the number of sponsors, conditions or trials and stay partitioned.
CALENDAR_SIZED = {"duration_trends", "sponsor_cohorts", "phase_distribution", "pipeline_trust"}


def frames(w: Warehouse) -> dict[str, DataFrame]:
    return {
        "approval_landscape": exports.export_approval_landscape(w.applicant_years),
        "phase_funnel": exports.export_phase_funnel(w.condition_funnel),
        "sponsor_league_table": exports.export_sponsor_league_table(w.dim_sponsor),
        "duration_trends": exports.export_duration_trends(w.metric_duration_trends),
        "sponsor_cohorts": exports.export_sponsor_cohorts(w.metric_sponsor_cohorts),
        "termination_reasons": exports.export_termination_reasons(w.fct_trials, w.dim_sponsor),
        "phase_distribution": exports.export_phase_distribution(w.fct_trials),
        "pipeline_trust": exports.export_pipeline_trust(w.condition_funnel, w.dim_condition, w.fct_trials),
    }


def write_csv(frame: DataFrame, folder: str, single_file: bool = False) -> None:
    """Header in every file, no index; sorted frames keep their order across files."""
    out = frame.coalesce(1) if single_file else frame
    out.write.mode("overwrite").option("header", True).csv(folder)


def export_all(w: Warehouse, folder: str) -> None:
    for name, frame in frames(w).items():
        write_csv(frame, f"{folder}/{name}", name in CALENDAR_SIZED)
