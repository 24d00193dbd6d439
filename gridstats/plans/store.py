"""Partials of each day, kept so that results need no second look at the readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.functions import times
from gridstats.operators.periods import filter_zone, time_column, with_period
from gridstats.operators.stats import finish_averages, merge_partials, period_stats
from gridstats.schema import COUNTRY, HOME_ZONE, METRICS, TIME, YEAR, YEAR_MONTH, ZONE
from gridstats.shared import remove_folder

DAY = "day"
_STATS = ("sum", "count", "min", "max")


def store_days(
    readings: DataFrame,
    path: str,
    time: str = TIME,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
    unit: str = "day",
) -> None:
    """Put the partials of every day of ``readings`` into the store at ``path``.

    A day is delivered whole: its rows replace what the store has of it, so that a delivery may be repeated
    or corrected, and other days stay as they are. Readings without a time are a day of their own, which is
    null. One row per zone and day is kept, in one file per day, however many readings a zone has. With
    ``unit`` ``month`` the same holds for months, under their first day: fewer files, larger deliveries.
    """
    if unit not in ("day", "month"):
        raise ValueError(f"unknown unit {unit!r}: day or month")
    day = time_column(readings, time, on_bad_time).cast("date")
    if on_bad_time == "drop":
        readings = readings.where(day.isNotNull())
    day = day if unit == "day" else times.month_start(day)
    days = readings.select(day.alias(DAY), F.col(zone).alias(ZONE), *metrics)
    partials = period_stats(days, [DAY, ZONE], metrics, _STATS)
    written = partials.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The store: ``zone_id``, sum, count, minimum and maximum of each metric, ``day``."""
    columns = ", ".join(f"{s}_{m} {'long' if s == 'count' else 'double'}" for m in metrics for s in _STATS)
    return spark.read.schema(f"{ZONE} string, {columns}, {DAY} date").parquet(path)


def forget_days(spark: SparkSession, path: str, days: Sequence[str]) -> None:
    """Take days, ``yyyy-MM-dd``, out of the store: a delivery without any reading of a day leaves it."""
    for day in days:
        remove_folder(spark, f"{path}/{DAY}={day}")


def zone_year_from_store(
    store: DataFrame, sort: bool = True, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """As ``zone_year_stats``, from the store alone."""
    years = with_period(store.withColumnRenamed(ZONE, COUNTRY), "year", time=DAY)
    merged = merge_partials(years, (COUNTRY, YEAR), metrics, _STATS)
    stats = finish_averages(merged, metrics)
    stats = stats.select(COUNTRY, YEAR, *[f"{s}_{m}" for m in metrics for s in ("avg", "min", "max")])
    return stats.orderBy(COUNTRY, YEAR) if sort else stats


def monthly_from_store(
    store: DataFrame, zone: str = HOME_ZONE, sort: bool = True, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """As ``monthly_averages``, from the store alone."""
    months = with_period(filter_zone(store, zone), "month_start", time=DAY)
    averages = finish_averages(merge_partials(months, ["month_start"], metrics), metrics)
    label = times.month_label(F.col("month_start")).alias(YEAR_MONTH)
    labelled = averages.select(label, *[f"avg_{m}" for m in metrics])
    return labelled.orderBy(YEAR_MONTH) if sort else labelled
