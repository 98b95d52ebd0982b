"""Operators from DataFrame to DataFrame. All are lazy but those of ``numbering``,
which write their sorted rows once."""

from factlab.operators.aggregates import (
    Stat,
    above_global_mean,
    daily_counts,
    global_mean,
    grouped_levels,
    grouped_stats,
    period_summary,
)
from factlab.operators.distinct import distinct_bitmaps, merged_distinct
from factlab.operators.filters import filter_all
from factlab.operators.joins import join_to_groups, lookup_join, merge_join
from factlab.operators.matching import exists_in, not_exists_in, not_in, outer_join
from factlab.operators.moving import moving_average
from factlab.operators.numbering import numbered, ranked
from factlab.operators.ranking import preview, top_k, top_ranked
from factlab.operators.reuse import shared
from factlab.operators.sessions import sessions
from factlab.operators.sketches import (
    distinct_sketches,
    error_bound,
    merged_distinct_estimate,
    merged_quantiles,
    quantile_sketches,
)
from factlab.operators.snapshots import key_changes, row_changes
from factlab.operators.time_joins import asof_join, by_day, by_days, interval_join

__all__ = [
    "Stat",
    "above_global_mean",
    "asof_join",
    "by_day",
    "by_days",
    "daily_counts",
    "distinct_bitmaps",
    "distinct_sketches",
    "error_bound",
    "exists_in",
    "filter_all",
    "global_mean",
    "grouped_levels",
    "grouped_stats",
    "interval_join",
    "join_to_groups",
    "key_changes",
    "lookup_join",
    "merge_join",
    "merged_distinct",
    "merged_distinct_estimate",
    "merged_quantiles",
    "moving_average",
    "not_exists_in",
    "not_in",
    "numbered",
    "outer_join",
    "period_summary",
    "preview",
    "quantile_sketches",
    "shared",
    "top_k",
    "top_ranked",
]
