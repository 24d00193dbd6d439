"""Period columns and the zone filter."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions import times
from gridstats.schema import DAY_OF_YEAR, MONTH, TIME, YEAR, YEAR_MONTH, ZONE


def time_column(df: DataFrame, time: str = TIME, on_bad: str = "null") -> Column:
    """The time of ``df`` as a UTC wall clock, whatever type the column has."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.StringType):
        return times.parse_time(F.col(time), on_bad)
    if isinstance(kind, T.TimestampType):
        return times.utc_wall_clock(F.col(time))
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.col(time).cast("timestamp_ntz")
    raise TypeError(f"column {time!r} holds {kind.simpleString()}, not a time")


# Unit -> columns, each made from the day of the reading.
_UNITS: dict[str, dict[str, Callable[[Column], Column]]] = {
    "year": {YEAR: F.year},
    "month": {YEAR_MONTH: lambda day: times.month_label(times.month_start(day))},
    "month_start": {"month_start": times.month_start},
    "year_month_parts": {YEAR: F.year, MONTH: F.month},
    "year_day_parts": {YEAR: F.year, DAY_OF_YEAR: F.dayofyear},
}


def with_period(
    df: DataFrame,
    unit: str | Sequence[str],
    out: str | None = None,
    time: str = TIME,
    on_bad_time: str = "null",
) -> DataFrame:
    """Add the period of each reading; several units share one parse of the time.

    A unit is ``year`` (int), ``month`` (``yyyy-MM`` text), ``month_start`` (date, the cheap grouping
    key for months), ``year_month_parts`` (ints ``year`` and ``month``) or ``year_day_parts`` (ints
    ``year`` and ``day_of_year``). ``out`` renames the column if there is just one. A time that cannot
    be read gives a null period (``null``), an error (``fail``) or no row (``drop``).
    """
    if on_bad_time not in ("null", "fail", "drop"):
        raise ValueError(f"unknown on_bad_time {on_bad_time!r}: null, fail or drop")
    units = [unit] if isinstance(unit, str) else list(unit)
    unknown = [u for u in units if u not in _UNITS]
    if unknown or not units:
        raise ValueError(f"unknown unit {unknown}: one of {sorted(_UNITS)}")
    columns = {name: make for u in units for name, make in _UNITS[u].items()}
    if out is not None:
        (make,) = columns.values()
        columns = {out: make}

    day = time_column(df, time, on_bad_time).cast("date")
    if on_bad_time == "drop":
        df = df.where(day.isNotNull())
    if len(columns) == 1:
        return df.withColumns({name: make(day) for name, make in columns.items()})
    # In a column of its own the time is parsed once, not once per part.
    own = "_day"
    while own in df.columns:
        own = f"_{own}"
    staged = df.withColumn(own, day)
    return staged.withColumns({n: make(F.col(own)) for n, make in columns.items()}).drop(own)


def period_start_ms(
    df: DataFrame,
    unit: str,
    out: str = "time_ms",
    year: str = YEAR,
    month: str = MONTH,
    label: str = YEAR_MONTH,
    day_of_year: str = DAY_OF_YEAR,
) -> DataFrame:
    """Add the start of a period, 00:00 UTC, in milliseconds.

    ``unit`` names the columns that hold the period: ``year``, ``month`` (the label),
    ``year_month_parts`` or ``day`` (year and day of year). A period that does not exist gives null.
    """
    if unit == "year":
        start = times.year_start_ms(F.col(year))
    elif unit == "month":
        start = times.month_start_ms(F.col(label))
    elif unit == "year_month_parts":
        start = times.day_ms(times.month_date_of(F.col(year), F.col(month)))
    elif unit == "day":
        start = times.day_of_year_start_ms(F.col(year), F.col(day_of_year))
    else:
        raise ValueError(f"unknown unit {unit!r}")
    return df.withColumn(out, start)


def filter_zone(df: DataFrame, zone: str, zone_column: str = ZONE) -> DataFrame:
    """Readings of one zone; reaches the Parquet scan as a pushed filter."""
    return df.where(F.col(zone_column) == F.lit(zone))
