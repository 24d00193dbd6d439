from gridstats.operators.periods import filter_zone, period_start_ms, time_column, with_period
from gridstats.operators.points import (
    monthly_points,
    points_to_lines,
    run_time_points,
    to_points,
    zone_year_points,
)
from gridstats.operators.ranking import (
    RANKINGS,
    monthly_extremes,
    monthly_rankings,
    top_k,
    top_k_per_key,
    zone_extremes,
)
from gridstats.operators.stats import (
    finish_averages,
    join_stats,
    merge_partials,
    period_stats,
    period_sums,
    result_sizes,
)

__all__ = [
    "RANKINGS",
    "filter_zone",
    "finish_averages",
    "join_stats",
    "merge_partials",
    "monthly_extremes",
    "monthly_points",
    "monthly_rankings",
    "period_start_ms",
    "period_stats",
    "period_sums",
    "points_to_lines",
    "result_sizes",
    "run_time_points",
    "time_column",
    "to_points",
    "top_k",
    "top_k_per_key",
    "with_period",
    "zone_extremes",
    "zone_year_points",
]
