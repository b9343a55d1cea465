"""DataFrame to DataFrame operators that run on bounded and streaming frames."""

from millrace.operators.aggregates import count_by, count_where, mean_of, spread_stats
from millrace.operators.filters import above, differs_from
from millrace.operators.joins import (
    STREAM_JOINS,
    full_interval_join,
    hot_keys,
    hot_layout,
    join_stream_static,
    join_streams,
    join_tables,
    settle_full,
)
from millrace.operators.windows import (
    LATE,
    best_sellers,
    late_safe_counts,
    pane_totals,
    processing_time_chars,
    slide_panes,
    sliding_totals,
    sliding_totals_closed,
    top_closed,
    top_per_window,
    top_sliding_closed,
    window_totals,
)

__all__ = [
    "LATE",
    "STREAM_JOINS",
    "above",
    "best_sellers",
    "count_by",
    "count_where",
    "differs_from",
    "full_interval_join",
    "hot_keys",
    "hot_layout",
    "join_stream_static",
    "join_streams",
    "join_tables",
    "late_safe_counts",
    "mean_of",
    "pane_totals",
    "processing_time_chars",
    "settle_full",
    "slide_panes",
    "sliding_totals",
    "sliding_totals_closed",
    "spread_stats",
    "top_closed",
    "top_per_window",
    "top_sliding_closed",
    "window_totals",
]
