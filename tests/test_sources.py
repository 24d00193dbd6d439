import pytest
from py4j.protocol import Py4JJavaError

import gridstats as gs
from gridstats.schema import READING_COLUMNS, READINGS

from conftest import tuples


@pytest.fixture
def csv(spark, tmp_path):
    def read(*lines, **options):
        path = tmp_path / "readings.csv"
        path.write_text("".join(line + "\n" for line in lines))
        return gs.read_readings(spark, str(path), "csv", **options)

    return read


GOOD = "2021-01-01 01:00:00,IT,1.5,2.5"
HEADER = "Datetime (UTC),Zone id,Carbon intensity gCO₂eq/kWh (direct),Carbon-free energy percentage (CFE%)"


def test_by_position(csv):
    df = csv(GOOD)
    assert df.schema == READINGS
    assert tuples(df) == [("2021-01-01 01:00:00", "IT", 1.5, 2.5)]


def test_header(csv):
    assert tuples(csv(HEADER, GOOD, header=True)) == [("2021-01-01 01:00:00", "IT", 1.5, 2.5)]
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        csv(HEADER, GOOD).collect()


@pytest.mark.parametrize(
    ("line", "row"),
    [
        ("2021-01-01 01:00:00,IT,1", (1.0, None)),
        ("2021-01-01 01:00:00,IT,abc,2.5", (None, 2.5)),
    ],
)
def test_bad_lines(csv, line, row):
    assert tuples(csv(line, mode="PERMISSIVE"))[0][2:] == row
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        csv(line).collect()


@pytest.mark.parametrize("mode", ["PERMISSIVE", "FAILFAST"])
def test_empty_number_is_null(csv, mode):
    assert tuples(csv("2021-01-01 01:00:00,IT,,2.5", mode=mode))[0][2:] == (None, 2.5)


def test_quoted_zone(csv):
    assert tuples(csv('2021-01-01 01:00:00,"A,B",1,2'))[0][1] == "A,B"


def test_parquet_takes_columns_by_name(spark, basic, tmp_path):
    path = str(tmp_path / "p")
    basic.selectExpr("1 as extra", *reversed(READING_COLUMNS)).write.parquet(path)
    df = gs.read_readings(spark, path)
    assert df.columns == list(READING_COLUMNS)
    assert sorted(tuples(df)) == sorted(tuples(basic))
    assert gs.read_readings(spark, [path, path]).count() == 8


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        gs.read_readings(spark, "x", "orc")


def test_both_formats_give_the_same_results(spark, random_readings, tmp_path):
    random_readings.write.parquet(str(tmp_path / "p"))
    columnar = gs.read_readings(spark, str(tmp_path / "p"))
    gs.write_csv(columnar, str(tmp_path / "c"), header=False)
    text = gs.read_readings(spark, str(tmp_path / "c"), "csv")
    assert text.count() == columnar.count()
    assert text.exceptAll(columnar).count() == 0 and columnar.exceptAll(text).count() == 0


def test_register(spark, basic):
    assert gs.register(basic, "some_readings") == "some_readings"
    assert spark.table("some_readings").count() == 4


def test_strict_parses_all_of_every_row(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "2021-01-01 00:00:00,IT,1.0,2.0\n2021-01-01 00:00:00,SE,1.0,bad\n"
    )
    loose = gs.read_readings(spark, str(tmp_path), "csv")
    assert gs.monthly_averages(loose, "IT", metrics=["carbon_intensity_gco2eq_per_kwh_direct"]).count() == 1
    strict = gs.read_readings(spark, str(tmp_path), "csv", strict=True)
    for work in (
        lambda: strict.count(),
        lambda: gs.monthly_averages(strict, "IT").collect(),
        lambda: gs.monthly_averages(strict, "IT", metrics=["carbon_intensity_gco2eq_per_kwh_direct"]).collect(),
    ):
        with pytest.raises(Exception, match="MALFORMED"):
            work()
