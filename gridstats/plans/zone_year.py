"""Average, minimum and maximum of the metrics per zone and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstats.operators.periods import with_period
from gridstats.operators.stats import finish_averages, period_stats
from gridstats.schema import COUNTRY, METRICS, TIME, YEAR, ZONE
from gridstats.shared import BUCKET_KEY, kept_in_buckets

KEYS = (COUNTRY, YEAR)


def zone_year_keyed(
    df: DataFrame,
    time: str = TIME,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
) -> DataFrame:
    """Readings reduced to ``country``, ``year`` and the metrics."""
    periods = with_period(df, "year", time=time, on_bad_time=on_bad_time)
    return periods.select(F.col(zone).alias(COUNTRY), YEAR, *metrics)


def zone_year_stats(
    df: DataFrame,
    sort: bool = True,
    time: str = TIME,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
) -> DataFrame:
    """Statistics per zone and year in one aggregate."""
    keyed = zone_year_keyed(df, time, zone, metrics, on_bad_time)
    stats = period_stats(keyed, KEYS, metrics)
    return stats.orderBy(*KEYS) if sort else stats


def zone_year_stats_merged(
    df: DataFrame,
    sort: bool = True,
    time: str = TIME,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
) -> DataFrame:
    """The same through mergeable sums and counts, still in one scan."""
    keyed = zone_year_keyed(df, time, zone, metrics, on_bad_time)
    partials = period_stats(keyed, KEYS, metrics, ("sum", "count", "min", "max"))
    stats = finish_averages(partials, metrics)
    return stats.orderBy(*KEYS) if sort else stats


def zone_year_stats_joined(
    df: DataFrame,
    sort: bool = True,
    time: str = TIME,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
) -> DataFrame:
    """The same as averages, minima and maxima that are made apart and joined on zone and year.

    The input is scanned once, when this is called, for partials that are kept in the shared folder; three
    separate aggregates over the readings would scan it three times, since each needs other columns. The
    partials lie in buckets of their keys, so that the joins move no row between tasks.
    """
    keyed = zone_year_keyed(df, time, zone, metrics, on_bad_time)
    partials = period_stats(keyed, KEYS, metrics, ("sum", "count", "min", "max"))
    partials = kept_in_buckets(partials, KEYS)

    def part(*stats: str) -> DataFrame:
        return partials.select(BUCKET_KEY, *[f"{s}_{m}" for m in metrics for s in stats])

    averages = finish_averages(partials.select(BUCKET_KEY, *KEYS, *[f"{s}_{m}" for m in metrics for s in ("sum", "count")]), metrics)
    joined = averages.join(part("min"), BUCKET_KEY).join(part("max"), BUCKET_KEY)
    result = joined.select(*KEYS, *[f"{s}_{m}" for m in metrics for s in ("avg", "min", "max")])
    return result.orderBy(*KEYS) if sort else result
