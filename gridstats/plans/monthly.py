"""Monthly averages of one zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstats.functions import times
from gridstats.operators.periods import filter_zone, with_period
from gridstats.operators.stats import finish_averages, period_stats, period_sums
from gridstats.schema import HOME_ZONE, METRICS, MONTH, TIME, YEAR, YEAR_MONTH, ZONE


def monthly_averages(
    df: DataFrame,
    zone: str = HOME_ZONE,
    keep_zone: bool = False,
    sort: bool = True,
    time: str = TIME,
    zone_column: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
) -> DataFrame:
    """Average of the metrics per month, ``yyyy-MM``; ``keep_zone`` adds ``zone_id`` as second column."""
    readings = filter_zone(df, zone, zone_column)
    # Grouped by a date, labelled afterwards: one text per month instead of one per reading.
    periods = with_period(readings, "month_start", time=time, on_bad_time=on_bad_time)
    kept = [zone_column] if keep_zone else []
    averages = period_stats(periods, ["month_start", *kept], metrics, ("avg",))
    labelled = averages.select(
        times.month_label(F.col("month_start")).alias(YEAR_MONTH),
        *[F.col(c).alias(ZONE) for c in kept],
        *[f"avg_{m}" for m in metrics],
    )
    return labelled.orderBy(YEAR_MONTH) if sort else labelled


def monthly_averages_merged(
    df: DataFrame,
    zone: str = HOME_ZONE,
    sort: bool = True,
    time: str = TIME,
    zone_column: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
) -> DataFrame:
    """The same through sums and counts per numeric year and month."""
    readings = filter_zone(df, zone, zone_column)
    periods = with_period(readings, "year_month_parts", time=time, on_bad_time=on_bad_time)
    averages = finish_averages(period_sums(periods, (YEAR, MONTH), metrics), metrics)
    if sort:
        averages = averages.orderBy(YEAR, MONTH)
    label = times.month_label(times.month_date_of(F.col(YEAR), F.col(MONTH))).alias(YEAR_MONTH)
    return averages.select(label, *[f"avg_{m}" for m in metrics])
