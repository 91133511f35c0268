"""Column expressions. All of them are built from JVM-side functions."""

from cohortline.functions.dates import compact_date, days_between, partial_date, year_span
from cohortline.functions.keys import normalized_name, surrogate_key
from cohortline.functions.labels import (
    decode_phase,
    decode_sponsor_class,
    fill_missing,
    is_combined_phase,
    traffic_light,
)
from cohortline.functions.ratios import rate, ratio, round_rates, row_count
from cohortline.functions.text import blank_to_null, joined_or_null, trimmed_or_null

__all__ = [
    "blank_to_null",
    "compact_date",
    "days_between",
    "decode_phase",
    "decode_sponsor_class",
    "fill_missing",
    "is_combined_phase",
    "joined_or_null",
    "normalized_name",
    "partial_date",
    "rate",
    "ratio",
    "round_rates",
    "row_count",
    "surrogate_key",
    "traffic_light",
    "trimmed_or_null",
    "year_span",
]
