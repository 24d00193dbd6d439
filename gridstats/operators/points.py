"""Results as time-series points: measurement, tags, fields and a UTC time in milliseconds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions import lines, times
from gridstats.schema import (
    APP_TAG,
    COUNTRY,
    FIELD_NAMES,
    RESULT_MEASUREMENT,
    RUN_TIME_FIELD,
    RUN_TIME_MEASUREMENT,
    YEAR,
    YEAR_MONTH,
    ZONE,
)

_STATISTICS = ("avg_", "min_", "max_", "sum_", "count_")


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _map(entries: Mapping[str, Column], kind: str) -> Column:
    pairs = [c for k, v in entries.items() for c in (F.lit(k), v.cast(kind))]
    return F.create_map(*pairs).cast(f"map<string,{kind}>")


def to_points(
    df: DataFrame,
    measurement: str,
    fields: Mapping[str, str | Column],
    tags: Mapping[str, str | Column],
    time_ms: str | Column,
) -> DataFrame:
    """One point per row: ``measurement, tags, fields, int_fields, time_ms``.

    Fields of an integer type stay integers, in ``int_fields``; all others are doubles. A field that is
    null, NaN or infinite and a tag that is null or empty are left out, and so is a row with no time or no
    field left: a time-series database takes none of these.
    """
    start = _column(time_ms).cast("bigint")
    columns = {name: _column(value) for name, value in fields.items()}
    types = df.select(*[c.alias(name) for name, c in columns.items()]).schema
    whole = {f.name for f in types if isinstance(f.dataType, T.IntegralType)}
    # The time is tested per field. A test on the time alone depends on grouping keys only: Spark would
    # push it below the aggregate and parse the time of every reading once more.
    finite = F.map_filter(
        _map({k: c for k, c in columns.items() if k not in whole}, "double"),
        lambda _, v: v.isNotNull()
        & ~F.isnan(v)
        & (F.abs(v) != F.lit(float("inf")))
        & start.isNotNull(),
    )
    integers = F.map_filter(
        _map({k: c for k, c in columns.items() if k in whole}, "bigint"),
        lambda _, v: v.isNotNull() & start.isNotNull(),
    )
    named = {name: _column(value) for name, value in tags.items()}
    present = F.map_filter(_map(named, "string"), lambda _, v: v.isNotNull() & (v != F.lit("")))
    points = df.select(
        F.lit(measurement).alias("measurement"),
        present.alias("tags"),
        finite.alias("fields"),
        integers.alias("int_fields"),
        start.alias("time_ms"),
    )
    return points.where((F.size("fields") > 0) | (F.size("int_fields") > 0))


def _app(df: DataFrame, app: str | None) -> Column:
    return F.lit(app if app is not None else df.sparkSession.conf.get("spark.app.name"))


def _fields(df: DataFrame, fields: Mapping[str, str] | None) -> Mapping[str, str]:
    """Field -> column: as given, or all statistics, the fixed ones under their field names."""
    if fields is None:
        numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
        found = [c for c in numbers if c.startswith(_STATISTICS)]
        fields = {FIELD_NAMES.get(c, c): c for c in found}
    if not fields:
        raise ValueError(f"no statistics among the columns {df.columns}")
    return fields


def zone_year_points(
    stats: DataFrame, app: str | None = None, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """Zone-year statistics as points at 1 January, tagged with zone and application.

    ``fields`` names the fields and their columns. By default every column of a statistic, ``avg_``,
    ``min_``, ``max_``, ``sum_`` or ``count_`` and a metric, is a field: those of the two fixed metrics
    under their fixed names, others under the name of the column.
    """
    return to_points(
        stats,
        RESULT_MEASUREMENT,
        _fields(stats, fields),
        {COUNTRY: COUNTRY, APP_TAG: _app(stats, app)},
        times.year_start_ms(F.col(YEAR)),
    )


def monthly_points(
    averages: DataFrame, app: str | None = None, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """Monthly averages as points at the first of the month, tagged with the application.

    If the averages carry the zone it becomes a tag too; without it, two zones under one application
    name would overwrite each other. ``fields`` as for ``zone_year_points``.
    """
    tags: dict[str, str | Column] = {APP_TAG: _app(averages, app)}
    if ZONE in averages.columns:
        tags[ZONE] = ZONE
    start = times.month_start_ms(F.col(YEAR_MONTH))
    return to_points(averages, RESULT_MEASUREMENT, _fields(averages, fields), tags, start)


def run_time_points(runs: DataFrame, app: str | None = None) -> DataFrame:
    """Timed runs, ``(start_ms, duration_ms)``, as points; a duration in whole milliseconds stays one."""
    return to_points(
        runs,
        RUN_TIME_MEASUREMENT,
        {RUN_TIME_FIELD: "duration_ms"},
        {APP_TAG: _app(runs, app)},
        "start_ms",
    )


def points_to_lines(points: DataFrame) -> DataFrame:
    """Points as line protocol text, column ``line``; integer fields end in ``i``."""
    columns = ("measurement", "tags", "fields", "int_fields", "time_ms")
    return points.select(lines.line(*[F.col(c) for c in columns]).alias("line"))
