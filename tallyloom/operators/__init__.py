"""DataFrame operators: dedup, aggregates, joins, time series, ranking, data tests."""

from tallyloom.operators.aggregates import (
    agg_global,
    count_by,
    distinct_error,
    distinct_over,
    distinct_sketches,
    pivot_metrics,
    union_all,
    unpivot_reactions,
)
from tallyloom.operators.dedup import (
    address_columns,
    dedup_earliest,
    dedup_latest,
    dedup_latest_stored,
    qualify_row_number,
    with_address,
)
from tallyloom.operators.joins import (
    join_cross_scalar,
    join_full_outer,
    join_left_enrich,
    join_left_spine,
)
from tallyloom.operators.quality import (
    check_accepted_values,
    check_expression,
    check_inputs_present,
    check_not_null,
    check_row_count,
    check_row_counts,
    check_unique,
    mart_row_summary,
    observe_checks,
    run_checks,
)
from tallyloom.operators.ranking import (
    last_n,
    numbered,
    sample_every_nth,
    top_k_by_count,
)
from tallyloom.operators.timeseries import (
    date_spine,
    expand_days,
    forward_fill,
    gap_fill,
    lag_change,
    running_sum,
)

__all__ = [
    "address_columns",
    "agg_global",
    "check_accepted_values",
    "check_expression",
    "check_inputs_present",
    "check_not_null",
    "check_row_count",
    "check_row_counts",
    "check_unique",
    "count_by",
    "date_spine",
    "dedup_earliest",
    "dedup_latest",
    "dedup_latest_stored",
    "distinct_error",
    "distinct_over",
    "distinct_sketches",
    "expand_days",
    "forward_fill",
    "gap_fill",
    "join_cross_scalar",
    "join_full_outer",
    "join_left_enrich",
    "join_left_spine",
    "lag_change",
    "last_n",
    "mart_row_summary",
    "numbered",
    "observe_checks",
    "pivot_metrics",
    "qualify_row_number",
    "run_checks",
    "running_sum",
    "sample_every_nth",
    "top_k_by_count",
    "union_all",
    "unpivot_reactions",
    "with_address",
]
