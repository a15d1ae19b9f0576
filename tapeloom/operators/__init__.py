"""DataFrame in, DataFrame out."""

from tapeloom.operators.aggregates import ceil_sum, sum_by
from tapeloom.operators.columns import format_date, in_order, mask, name_case
from tapeloom.operators.joins import fanout_report, join_lookup, join_rows
from tapeloom.operators.quality import preview, quality_report, row_count, sample_by_key, sample_exact, schema_violations
from tapeloom.operators.windows import rank_within, running_totals, totals_over

__all__ = [
    "ceil_sum",
    "fanout_report",
    "format_date",
    "in_order",
    "join_lookup",
    "join_rows",
    "mask",
    "name_case",
    "preview",
    "quality_report",
    "rank_within",
    "row_count",
    "running_totals",
    "sample_by_key",
    "sample_exact",
    "schema_violations",
    "sum_by",
    "totals_over",
]
