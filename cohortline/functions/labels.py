from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display labels of the registry codes.
SPONSOR_CLASS_LABELS = {
    "INDUSTRY": "Industry",
    "NIH": "NIH",
    "FED": "Federal",
    "OTHER_GOV": "Other Government",
    "NETWORK": "Network",
    "INDIV": "Individual",
    "AMBIG": "Ambiguous",
    "OTHER": "Other",
    "UNKNOWN": "Unknown",
}
PHASE_LABELS = {
    "EARLY_PHASE1": "Early Phase 1",
    "PHASE1": "Phase 1",
    "PHASE2": "Phase 2",
    "PHASE3": "Phase 3",
    "PHASE4": "Phase 4",
    "NA": "N/A",
}


def _lookup(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code; a code without a label stands for itself."""
    table = F.create_map(*(F.lit(item) for pair in labels.items() for item in pair))
    return F.coalesce(F.try_element_at(table, code), code)


def decode_sponsor_class(code: Column) -> Column:
    return F.coalesce(_lookup(code, SPONSOR_CLASS_LABELS), F.lit("Unknown"))


def decode_phase(code: Column) -> Column:
    """Each part of a combined phase decoded on its own, then joined again."""
    parts = F.transform(F.split(code, r"\|"), lambda part: _lookup(part, PHASE_LABELS))
    return F.coalesce(F.array_join(parts, " / "), F.lit("Not Reported"))


def is_combined_phase(phase: Column, stage: str) -> Column:
    """Whether a phase text mentions a stage, in any case; missing is false."""
    return F.coalesce(phase.ilike(f"%{stage}%"), F.lit(False))


def fill_missing(value: Column, label: str) -> Column:
    return F.coalesce(value, F.lit(label))


def traffic_light(value: Column, good_max: float, warning_max: float) -> Column:
    """Lower is better: up to good_max is green, up to warning_max amber, above it red."""
    return (
        F.when(value <= good_max, F.lit("green"))
        .when(value <= warning_max, F.lit("amber"))
        .otherwise(F.lit("red"))
    )
