"""Reusable DataFrame operators the models are composed of."""

from cohortline.operators.dedupe import latest_by_key, upsert
from cohortline.operators.expand import active_spans, count_by_year, unnest
from cohortline.operators.groups import (
    approval_by_application,
    mode_per_group,
    per_group_totals,
    percentile_bands,
    value_histogram,
)
from cohortline.operators.joins import lookup, lookup_with_null, match_by_name, one_row, orphans, with_summary
from cohortline.operators.ranking import first_per_group, number_rows, rows_of_top_members, top_k
from cohortline.operators.series import add_lag, add_launch_value, add_share, split_at

__all__ = [
    "active_spans",
    "add_lag",
    "add_launch_value",
    "add_share",
    "approval_by_application",
    "count_by_year",
    "first_per_group",
    "latest_by_key",
    "lookup",
    "lookup_with_null",
    "match_by_name",
    "mode_per_group",
    "number_rows",
    "one_row",
    "orphans",
    "per_group_totals",
    "percentile_bands",
    "rows_of_top_members",
    "split_at",
    "top_k",
    "unnest",
    "upsert",
    "value_histogram",
    "with_summary",
]
