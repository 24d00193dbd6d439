"""CSV readings and the lines set aside."""

import pytest

import gridstats as gs
from gridstats.schema import CFE, CI, TIME

from conftest import final_plan, tuples

LINES = [
    ("2021-01-01 00:00:00,IT,1.5,20", None),
    ("2021-01-01 01:00:00,IT,,", None),
    (",IT,1,2", None),
    ('2021-01-01 00:00:00,"a, ""b"" \\",1e2,-0.0', None),
    ("2021-01-01 00:00:00,IT,NaN,Infinity", None),
    ("2021-01-01 00:00:00,IT,n/a,20", CI),
    ("2021-01-01 00:00:00,IT,1.5,20%", CFE),
    ("2021-01-01 00:00:00,IT,x,y", CI),
    ("2021-01-01 00:00:00,IT,1.5", "fields"),
    ("2021-01-01 00:00:00,IT,1.5,20,more", "fields"),
    ("2021/01/01 00:00:00,IT,1.5,20", TIME),
    ("2021-1-1 00:00:00,IT,1.5,20", TIME),
    ("bad,IT,bad,20", CI),
    ("just one", "fields"),
]


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    for i in (0, 1):
        (folder / f"{i}.csv").write_text("\n".join(["t,z,a,b", *[line for line, _ in LINES[i::2]]]) + "\n")
    return str(folder)


def test_good_and_bad_lines(spark, files):
    good, bad = gs.split_readings(spark, files, header=True)
    assert sorted(tuples(bad)) == sorted((line, why) for line, why in LINES if why)
    assert good.columns == gs.read_readings(spark, files, "csv", header=True).columns
    whole = sorted(tuples(good), key=str)
    assert len(whole) == 5 and ("2021-01-01 00:00:00", 'a, "b" \\', 100.0, -0.0) in whole
    assert (None, "IT", 1.0, 2.0) in whole and ("2021-01-01 01:00:00", "IT", None, None) in whole


def test_agrees_with_the_reader_on_whole_files(spark, random_readings, tmp_path):
    gs.write_csv(random_readings, str(tmp_path / "c"), header=False)
    good, bad = gs.split_readings(spark, str(tmp_path / "c"), out=str(tmp_path / "o"))
    assert bad.count() == 0
    assert sorted(tuples(good), key=str) == sorted(tuples(gs.read_readings(spark, str(tmp_path / "c"), "csv")), key=str)


def test_a_header_is_a_line_if_none_is_announced(spark, files):
    good, bad = gs.split_readings(spark, files)
    assert bad.where("line = 't,z,a,b'").count() == 2 and good.count() == 5


def test_both_outputs_are_read_from_one_pass(spark, files, tmp_path):
    good, bad = gs.split_readings(spark, files, header=True, out=str(tmp_path / "o"))
    for df in (good, bad):
        plan = final_plan(df)
        assert "csv" not in plan.replace("from_csv", "") and plan.count("FileScan") == 1 and "PartitionFilters" in plan
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        gs.split_readings(spark, files, out=str(tmp_path / "o"))


def test_statistics_of_the_good_ones(spark, files):
    good, _ = gs.split_readings(spark, files, header=True)
    assert gs.zone_year_stats(good.where("zone_id = 'IT' AND isnan(carbon_intensity_gco2eq_per_kwh_direct) IS NOT TRUE")).count() == 2
