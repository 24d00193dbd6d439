import json
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

import __spark_entry__ as entry
import gridstats as gs
from gridstats.schema import AVG_CFE, AVG_CI, YEAR_MONTH
from gridstats.shared import kept, new_folder, shared_folder

from conftest import tuples


def lines(folder):
    """Lines of all part files in name order, per file."""
    parts = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    return [p.read_text().splitlines() for p in parts]


def test_zone_year_csv(basic, tmp_path):
    path = tmp_path / "q1"
    gs.save_zone_year_report(gs.zone_year_stats(basic), str(path))
    header = ",".join(gs.zone_year_stats(basic).columns)
    files = [f for f in lines(path) if f]
    assert all(f[0] == header for f in files)
    assert [line for f in files for line in f[1:]] == [
        "IT,2021,200.0,100.0,300.0,40.0,20.0,60.0",
        "SE,2022,10.0,10.0,10.0,90.0,90.0,90.0",
    ]


def test_sorted_over_the_part_files(random_readings, tmp_path):
    gs.save_zone_year_report(gs.zone_year_stats(random_readings), str(tmp_path / "q1"), header=False)
    keys = [line.split(",")[:2] for f in lines(tmp_path / "q1") for line in f]
    assert len(keys) == 18 and keys == sorted(keys)


def test_existing_folder_is_refused_before_any_work(spark, basic, tmp_path):
    path = str(tmp_path / "q1")
    gs.write_csv(basic, path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        gs.write_csv(basic, path)
    gs.write_csv(basic, path, mode="overwrite")

    def boom(_):
        raise RuntimeError("the input was read")
        yield

    never = gs.zone_year_stats(basic.mapInArrow(boom, basic.schema))
    with pytest.raises(FileExistsError):
        gs.save_zone_year_report(never, path)
    gs.require_absent(spark, str(tmp_path / "nothing"))
    gs.write_csv(basic, str(tmp_path / "q2" / "top-cfe-asc.csv"))
    with pytest.raises(FileExistsError, match="top-cfe-asc"):
        gs.save_monthly_report(gs.monthly_averages(basic), str(tmp_path / "q2"))


def test_headerless(basic, tmp_path):
    gs.write_csv(basic.coalesce(1), str(tmp_path / "c"), header=False)
    assert lines(tmp_path / "c")[0][0] == "2021-01-01 00:00:00,IT,100.0,40.0"


@pytest.mark.parametrize("keep_zone", [False, True])
def test_monthly_report(basic, tmp_path, keep_zone):
    averages = gs.monthly_averages(basic, keep_zone=keep_zone)
    gs.save_monthly_report(averages, str(tmp_path / "q2"), k=1)
    assert sorted(p.name for p in (tmp_path / "q2").iterdir()) == [
        "plot.csv", "top-cfe-asc.csv", "top-cfe-desc.csv", "top-ci-asc.csv", "top-ci-desc.csv",
    ]
    plot = [line for f in lines(tmp_path / "q2" / "plot.csv") for line in f[1:]]
    assert plot == ["2021-01,150.0,50.0", "2021-02,300.0,20.0"]
    zone = ["zone_id"] if keep_zone else []
    for name, month, values in (
        ("ci-desc", "2021-02", ["300.0", "20.0"]),
        ("ci-asc", "2021-01", ["150.0", "50.0"]),
        ("cfe-desc", "2021-01", ["150.0", "50.0"]),
        ("cfe-asc", "2021-02", ["300.0", "20.0"]),
    ):
        row = [month, *(["IT"] if keep_zone else []), *values]
        expected = [",".join([YEAR_MONTH, *zone, AVG_CI, AVG_CFE]), ",".join(row)]
        assert lines(tmp_path / "q2" / f"top-{name}.csv") == [expected]


def test_empty_zone(basic, tmp_path):
    gs.save_monthly_report(gs.monthly_averages(basic, "XX"), str(tmp_path / "q2"))
    assert len(list((tmp_path / "q2").iterdir())) == 5


def test_reports_send_points(spark, basic, tmp_path):
    folder = str(tmp_path)

    def factory():
        class Writer:
            def write(self, points):
                with open(f"{folder}/{os.getpid()}.sent", "a") as out:
                    out.writelines(json.dumps([p.tags, p.time_ms]) + "\n" for p in points)

            def close(self):
                pass

        return Writer()

    gs.save_zone_year_report(gs.zone_year_stats(basic), f"{folder}/q1", factory, "one")
    gs.save_monthly_report(gs.monthly_averages(basic), f"{folder}/q2", factory, "two")
    sent = [json.loads(s) for p in tmp_path.glob("*.sent") for s in p.read_text().splitlines()]
    assert sorted((t["app"], t.get("country", ""), ms) for t, ms in sent) == [
        ("one", "IT", 1609459200000),
        ("one", "SE", 1640995200000),
        ("two", "", 1609459200000),
        ("two", "", 1612137600000),
    ]


def test_text_survives_a_csv_file(spark, make, tmp_path):
    zones = [" pad ", 'say "x"', "a,b", "back\\slash", "ends\\", "\\", "'", "\t tab", "", None]
    rows = make(*[("2021-01-01 00:00:00", z, float(i), 1.0) for i, z in enumerate(zones)])
    gs.write_csv(rows, str(tmp_path / "c"), header=False)
    read = {int(r[2]): r[1] for r in gs.read_readings(spark, str(tmp_path / "c"), "csv").collect()}
    # An empty text comes back as null, as the docstring says.
    assert [read[i] for i in range(len(zones))] == [z or None for z in zones]


def test_reports_leave_nothing_beside_their_output(spark, basic, tmp_path):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir()) if shared.exists() else set()
    gs.save_zone_year_report(gs.zone_year_stats(basic), str(tmp_path / "q1"))
    gs.save_monthly_report(gs.monthly_averages(basic), str(tmp_path / "q2"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["q1", "q2"]
    assert (set(shared.iterdir()) if shared.exists() else set()) == before


def test_shared_folder_is_that_of_the_context_first(spark, tmp_path):
    folder = spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark, "elsewhere") == folder
    assert new_folder(spark, "x").startswith(f"{folder}/gridstats-x-")


def test_kept_table_is_read_from_its_folder(spark, basic):
    once = kept(gs.zone_year_stats(basic))
    assert sorted(tuples(once)) == sorted(tuples(gs.zone_year_stats(basic)))
    assert all(f.startswith("file:") for f in once.inputFiles())


def test_client_uris():
    assert entry.client_uri("/tmp/x") == "file:///tmp/x"
    assert entry.client_uri("file:/tmp/x") == entry.client_uri("file:///tmp/x") == "file:///tmp/x"
    assert entry.client_uri("s3a://bucket/key") == entry.client_uri("s3n://bucket/key") == "s3://bucket/key"
    assert entry.client_uri("hdfs://name:8020/a") == "hdfs://name:8020/a"
    with pytest.raises(ValueError, match="dbfs"):
        entry.client_uri("dbfs:/a")
