import random
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import gridstats as gs
from gridstats.functions.times import parse_time
from gridstats.schema import TIME_FORMAT

from conftest import tuples

BAD = [
    "bad", "", " ", "2021-01-01", "2021-1-5 00:00:00", " 2021-01-05 00:00:00", "2021-01-05 00:00:00 ",
    "2021-01-05T00:00:00", "2021-1-1 00:00:00.0", "2021-01-01 00:00:0Z", "2021-01-01 0:00:00Z",
    "12021-1-01 00:00:00", "2021-02-30 00:00:00", "2021-13-01 00:00:00", "2021-01-01 24:00:00",
    "2021-01-01 00:60:00", "2021-01-01 00:00:60", "-202-01-01 00:00:00",
    "+021-01-01 00:00:00", "2021-01-01 00:00:00\n", "2021-01-01 00:00:0\n", "2021-01-01  0:00:00",
    "2021-01-1  00:00:00", "2021-1-01  00:00:00", "2021-01-01 +1:00:00", "２021-01-01 00:00:0",
    "2021-01-01 00:00 UTC", "1999-1-1 1+01:00:00",
]
GOOD = {
    "2021-01-01 00:00:00": datetime(2021, 1, 1),
    "2020-02-29 23:59:59": datetime(2020, 2, 29, 23, 59, 59),
    "0001-01-01 00:00:00": datetime(1, 1, 1),
    "9999-12-31 23:00:00": datetime(9999, 12, 31, 23),
    "2021-03-14 02:30:00": datetime(2021, 3, 14, 2, 30),
    "2021-06-01 10:30:15": datetime(2021, 6, 1, 10, 30, 15),
}


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "datetime_utc string")


def test_good_and_bad_times(spark):
    parsed = texts(spark, [*GOOD, *BAD]).select("datetime_utc", parse_time(F.col("datetime_utc")))
    got = dict(tuples(parsed))
    assert {t: got[t] for t in GOOD} == GOOD
    assert [t for t in BAD if got[t] is not None] == []


def test_same_as_the_pattern_formatter(spark):
    """Damaged times are taken or refused exactly as by a formatter with the pattern, but for years
    before 0000 or after 9999, written with a sign, which the formatter takes."""
    rng = random.Random(3)
    values = {*BAD, *GOOD, "0000-01-01 00:00:00"}
    while len(values) < 6000:
        text = list(rng.choice(["2021-01-01 00:00:00", "1999-12-31 23:59:59", "2020-02-29 11:00:00"]))
        for _ in range(rng.choice([1, 1, 2, 3])):
            spot = rng.randrange(len(text))
            how = rng.randrange(3)
            if how == 0:
                text[spot] = rng.choice("0123456789-: TZ.+")
            elif how == 1:
                text.insert(spot, rng.choice("0123456789-: TZ.+"))
            else:
                del text[spot]
        values.add("".join(text))
    both = texts(spark, sorted(values)).select(
        "datetime_utc",
        parse_time(F.col("datetime_utc")).alias("ours"),
        F.try_to_timestamp("datetime_utc", F.lit(TIME_FORMAT)).cast("timestamp_ntz").alias("theirs"),
    )
    both = both.withColumns({c: F.col(c).cast("string") for c in ("ours", "theirs")}).cache()
    assert both.where("ours is not null").count() > 200
    differ = both.where("not (ours <=> theirs)")
    assert tuples(differ.where(~F.col("datetime_utc").rlike(r"^[+-]"))) == []


def test_units(basic):
    first = "2021-02-01 00:00:00"
    row = {}
    for unit in ("year", "month", "month_start", "year_month_parts", "year_day_parts"):
        df = gs.with_period(basic, unit)
        row |= df.where(F.col("datetime_utc") == first).first().asDict()
    assert (row["year"], row["year_month"], row["month_start"]) == (2021, "2021-02", date(2021, 2, 1))
    assert (row["month"], row["day_of_year"]) == (2, 32)
    assert dict(gs.with_period(basic, "year").dtypes)["year"] == "int"
    together = gs.with_period(basic, ["year_day_parts", "month"]).where("datetime_utc like '2021-02%'")
    assert tuples(together)[0][4:] == (2021, 32, "2021-02")
    assert gs.with_period(basic, "year", out="y").columns[-1] == "y"
    for bad in ("week", [], ["year", "week"]):
        with pytest.raises(ValueError):
            gs.with_period(basic, bad)
    with pytest.raises(ValueError):
        gs.with_period(basic, "year_month_parts", out="y")
    with pytest.raises(ValueError):
        gs.with_period(basic, "year", on_bad_time="skip")


def test_bad_time_modes(make):
    df = make(("bad", "IT", 3.0, 4.0), ("2021-01-01 00:00:00", "IT", 1.0, 2.0), (None, "IT", 5.0, 6.0))
    years = lambda mode: sorted(
        (r.year for r in gs.with_period(df, "year", on_bad_time=mode).collect()), key=str
    )
    assert years("null") == [2021, None, None]
    assert years("drop") == [2021]
    with pytest.raises(PySparkException, match="not a time"):
        years("fail")
    fine = df.where("not datetime_utc <=> 'bad'")
    assert sorted(
        (r.year for r in gs.with_period(fine, "year", on_bad_time="fail").collect()), key=str
    ) == [2021, None]
    with pytest.raises(PySparkException, match="not a time"):
        gs.zone_year_stats(df, on_bad_time="fail").collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata", "Pacific/Apia"])
def test_results_do_not_depend_on_the_session_time_zone(spark, make, zone):
    df = make(
        ("2020-12-31 23:00:00", "IT", 1.0, 1.0),
        ("2021-01-01 00:00:00", "IT", 2.0, 2.0),
        ("2021-03-14 02:30:00", "IT", 3.0, 3.0),
        ("2011-12-30 05:00:00", "IT", 4.0, 4.0),
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stats = gs.zone_year_stats(df)
        assert [(r.year, r[2]) for r in stats.collect()] == [(2011, 4.0), (2020, 1.0), (2021, 2.5)]
        months = gs.monthly_averages(df)
        assert [r.year_month for r in months.collect()] == ["2011-12", "2020-12", "2021-01", "2021-03"]
        assert [p.time_ms for p in gs.zone_year_points(stats, "a").collect()] == [
            1293840000000, 1577836800000, 1609459200000,
        ]
        assert sorted(p.time_ms for p in gs.monthly_points(months, "a").collect()) == [
            1322697600000, 1606780800000, 1609459200000, 1614556800000,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_column_types(spark, zone):
    """Text, a wall clock and an instant give the same year; a number is refused."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        base = spark.sql("select timestamp'2020-12-31 23:30:00 UTC' as at")
        forms = base.select(
            F.col("at"),
            F.lit("2020-12-31 23:30:00").alias("text"),
            F.lit("2020-12-31 23:30:00").cast("timestamp_ntz").alias("wall"),
            F.lit("2020-12-31").cast("date").alias("day"),
            F.lit(5).alias("number"),
        )
        for name in ("at", "text", "wall", "day"):
            assert gs.with_period(forms, "year", time=name).first().year == 2020
        with pytest.raises(TypeError):
            gs.with_period(forms, "year", time="number")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_period_starts(spark):
    df = spark.createDataFrame(
        [(2021, 3, 60, "2021-03"), (2021, 13, 366, "2021-13"), (2020, 12, 366, "2021-3"), (2021, 1, 0, "x")],
        "year int, month int, day_of_year int, year_month string",
    )
    for unit in ("year", "month", "year_month_parts", "day"):
        df = gs.period_start_ms(df, unit, f"{unit}_ms")
    assert tuples(df.select("year_ms", "month_ms", "year_month_parts_ms", "day_ms")) == [
        (1609459200000, 1614556800000, 1614556800000, 1614556800000),
        (1609459200000, None, None, None),
        (1577836800000, None, 1606780800000, 1609372800000),
        (1609459200000, None, 1609459200000, None),
    ]
    starts = gs.period_start_ms(
        spark.createDataFrame([(2021, "2021-03"), (1970, "2021-13"), (1969, None)], "year int, year_month string"),
        "year",
        "y",
    )
    starts = gs.period_start_ms(starts, "month", "m")
    assert tuples(starts.select("y", "m")) == [
        (1609459200000, 1614556800000), (0, None), (-31536000000, None),
    ]
    with pytest.raises(ValueError):
        gs.period_start_ms(starts, "week")


def test_a_column_of_the_caller_stays(basic):
    own = basic.withColumn("_day", F.lit("mine"))
    parts = gs.with_period(own, ["year_month_parts", "month"])
    assert parts.columns == [*own.columns, "year", "month", "year_month"]
    assert {r._day for r in parts.collect()} == {"mine"}
