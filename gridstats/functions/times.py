"""Time expressions: parsing, periods and the UTC start of a period.

Nothing here depends on the session time zone. Text becomes TIMESTAMP_NTZ, the UTC wall clock, and the
start of a period is counted in days since 1970-01-01.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstats.schema import MONTH_FORMAT

MS_PER_DAY = 86_400_000
_WALL_CLOCK = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_time(text: Column, on_bad: str = "null") -> Column:
    """Parse ``yyyy-MM-dd HH:mm:ss`` text, years 0000 to 9999.

    Other text, also text that a plain cast would take such as ``2021-1-5``, gives null, or an error
    with ``on_bad="fail"``. Null stays null.
    """
    # The cast is several times faster than a pattern formatter but takes more forms, so the form is
    # checked first. Readings are hourly: the cheap test settles a full hour without the regex.
    full_hour = (
        text.endswith(F.lit(":00:00"))
        & (F.locate("-", text, 5) == 5)
        & (F.locate(" ", text, 11) == 11)
    )
    well_formed = (F.octet_length(text) == 19) & (full_hour | text.rlike(_WALL_CLOCK))
    parsed = F.when(well_formed, text.try_cast("timestamp_ntz"))
    if on_bad != "fail":
        return parsed
    error = F.raise_error(F.concat(F.lit("not a time of the form yyyy-MM-dd HH:mm:ss: "), text))
    return F.coalesce(parsed, F.when(text.isNotNull(), error.cast("timestamp_ntz")))


def utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP as the TIMESTAMP_NTZ that a clock in UTC shows."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def month_start(day: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    """``yyyy-MM`` of a date."""
    return F.date_format(day, MONTH_FORMAT)


def month_date(label: Column) -> Column:
    """First day of a ``yyyy-MM`` month; null for anything else."""
    well_formed = label.rlike(r"^\d{4}-\d{2}$")
    return F.when(well_formed, F.concat(label, F.lit("-01")).try_cast("date"))


def month_date_of(year: Column, month: Column) -> Column:
    """First day of a month given by numbers; null if there is no such month."""
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def day_ms(day: Column) -> Column:
    """00:00 UTC of a date, in milliseconds since 1970."""
    return F.unix_date(day).cast("bigint") * F.lit(MS_PER_DAY).cast("bigint")


def year_start_ms(year: Column) -> Column:
    return day_ms(F.make_date(year, F.lit(1), F.lit(1)))


def month_start_ms(label: Column) -> Column:
    return day_ms(month_date(label))


def day_of_year_start_ms(year: Column, day_of_year: Column) -> Column:
    """Start of the n-th day of a year; null if the year has no such day."""
    day = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day_of_year - 1)
    return F.when(F.year(day) == year, day_ms(day))
