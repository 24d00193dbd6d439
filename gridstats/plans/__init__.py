from gridstats.plans.monthly import monthly_averages, monthly_averages_merged
from gridstats.plans.reports import (
    MonthlyReport,
    monthly_report,
    save_monthly_report,
    save_zone_year_report,
)
from gridstats.plans.sqlforms import (
    monthly_averages_sql,
    monthly_rankings_sql,
    top_k_sql,
    zone_year_stats_sql,
)
from gridstats.plans.store import (
    forget_days,
    monthly_from_store,
    read_days,
    store_days,
    zone_year_from_store,
)
from gridstats.plans.zone_year import (
    zone_year_keyed,
    zone_year_stats,
    zone_year_stats_joined,
    zone_year_stats_merged,
)

__all__ = [
    "MonthlyReport",
    "forget_days",
    "monthly_averages",
    "monthly_averages_merged",
    "monthly_averages_sql",
    "monthly_from_store",
    "monthly_rankings_sql",
    "monthly_report",
    "read_days",
    "save_monthly_report",
    "save_zone_year_report",
    "store_days",
    "top_k_sql",
    "zone_year_from_store",
    "zone_year_keyed",
    "zone_year_stats",
    "zone_year_stats_joined",
    "zone_year_stats_merged",
    "zone_year_stats_sql",
]
