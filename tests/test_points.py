import json
import random

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

import gridstats as gs
from gridstats.schema import AVG_CFE, AVG_CI, CFE, CI, FIELD_NAMES, POINTS, YEAR_MONTH

from conftest import tuples


def test_zone_year_points(basic):
    points = gs.zone_year_points(gs.zone_year_stats(basic), "run 1")
    assert [(f.name, f.dataType.simpleString()) for f in points.schema] == [
        (f.name, f.dataType.simpleString()) for f in POINTS
    ]
    italy = points.where("tags['country'] = 'IT'").first()
    assert (italy.measurement, italy.tags) == ("result", {"country": "IT", "app": "run 1"})
    assert italy.time_ms == 1609459200000
    assert italy.fields == {
        "avg_ci_gco2eq_per_kwh": 200.0, "min_ci_gco2eq_per_kwh": 100.0, "max_ci_gco2eq_per_kwh": 300.0,
        "avg_cfe_percentage": 40.0, "min_cfe_percentage": 20.0, "max_cfe_percentage": 60.0,
    }
    assert set(italy.fields) == set(FIELD_NAMES.values())


def test_bounds_in_points(random_readings):
    for p in gs.zone_year_points(gs.zone_year_stats(random_readings), "a").collect():
        for m in ("ci_gco2eq_per_kwh", "cfe_percentage"):
            low, mean, high = (p.fields[f"{s}_{m}"] for s in ("min", "avg", "max"))
            assert low <= mean <= high


def test_default_app_is_the_session_name(basic):
    points = gs.zone_year_points(gs.zone_year_stats(basic))
    assert points.first().tags["app"] == "gridstats-tests"


def test_monthly_points(basic):
    points = gs.monthly_points(gs.monthly_averages(basic), "a").orderBy("time_ms").collect()
    assert [tuple(p) for p in points] == [
        ("result", {"app": "a"}, {"avg_ci_gco2eq_per_kwh": 150.0, "avg_cfe_percentage": 50.0}, {}, 1609459200000),
        ("result", {"app": "a"}, {"avg_ci_gco2eq_per_kwh": 300.0, "avg_cfe_percentage": 20.0}, {}, 1612137600000),
    ]
    tagged = gs.monthly_points(gs.monthly_averages(basic, keep_zone=True), "a").first()
    assert tagged.tags == {"app": "a", "zone_id": "IT"}


def test_what_a_database_cannot_take_is_left_out(make):
    nan = float("nan")
    df = make(
        ("2021-01-01 00:00:00", "IT", nan, None),
        ("2021-01-01 01:00:00", "IT", 7.0, None),
        ("bad", "IT", 1.0, 1.0),
        ("2021-01-01 00:00:00", "SE", None, None),
        ("2021-01-01 00:00:00", "DE", float("inf"), 1.0),
        ("2021-01-01 00:00:00", None, 2.0, None),
    )
    points = gs.zone_year_points(gs.zone_year_stats(df), "").collect()
    got = {p.tags.get("country"): p.fields for p in points}
    assert all("app" not in p.tags for p in points) and len(points) == 3
    assert got["IT"] == {"min_ci_gco2eq_per_kwh": 7.0}
    assert set(got["DE"]) == {f"{s}_cfe_percentage" for s in ("avg", "min", "max")}
    assert set(got[None]) == {f"{s}_ci_gco2eq_per_kwh" for s in ("avg", "min", "max")}


def test_every_statistic_is_a_field(spark, basic):
    other = basic.withColumnsRenamed({CI: "x", CFE: "y"})
    stats = gs.zone_year_stats(other, metrics=["x", "y"])
    points = gs.zone_year_points(stats, "a")
    assert points.count() == 2
    assert set(points.first().fields) == {f"{s}_{m}" for s in ("avg", "min", "max") for m in ("x", "y")}
    both = gs.zone_year_stats(basic.withColumn("x", F.col(CI)), metrics=[CI, "x"])
    assert set(gs.zone_year_points(both, "a").first().fields) == {
        *[f"{s}_ci_gco2eq_per_kwh" for s in ("avg", "min", "max")],
        *[f"{s}_x" for s in ("avg", "min", "max")],
    }
    named = gs.zone_year_points(stats, "a", fields={"mean": "avg_x"})
    assert named.first().fields == {"mean": 200.0}
    months = gs.monthly_averages(other, metrics=["x"])
    assert gs.monthly_points(months, "a").first().fields == {"avg_x": 150.0}
    counts = gs.zone_year_points(gs.period_sums(gs.zone_year_keyed(basic), ["country", "year"]), "a")
    assert set(counts.first().int_fields) == {f"count_{CI}", f"count_{CFE}"}


def test_no_statistics_is_an_error(basic):
    with pytest.raises(ValueError, match="no statistics"):
        gs.zone_year_points(gs.zone_year_stats(basic).select("country", "year"), "a")


def test_month_that_is_no_month_gives_no_point(spark):
    rows = [("2021-03", 1.0, 1.0), ("2021-13", 1.0, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, f"{YEAR_MONTH} string, {AVG_CI} double, {AVG_CFE} double")
    assert [p.time_ms for p in gs.monthly_points(df, "a").collect()] == [1614556800000]


def test_no_tags(spark):
    points = gs.to_points(spark.range(1), "m", {"f": F.lit(1.5)}, {}, F.lit(7))
    assert tuples(gs.points_to_lines(points)) == [("m f=1.5 7",)]


def test_lines(spark):
    one = spark.range(1)

    def text(measurement, tags, fields):
        tags = {k: F.lit(v) for k, v in tags.items()}
        fields = {k: F.lit(v) for k, v in fields.items()}
        points = gs.to_points(one, measurement, fields, tags, F.lit(1609459200000))
        return gs.points_to_lines(points).first().line

    assert text("result", {"country": "X,Y", "app": "a b"}, {"avg_ci_gco2eq_per_kwh": 1.5}) == (
        "result,app=a\\ b,country=X\\,Y avg_ci_gco2eq_per_kwh=1.5 1609459200000"
    )
    assert text("m=, x", {"k =,": "v=1"}, {"f, =": -0.5}) == (
        "m=\\,\\ x,k\\ \\=\\,=v\\=1 f\\,\\ \\==-0.5 1609459200000"
    )
    assert text("m", {"t": "two\nlines\tand\rmore"}, {"f": 1.0}) == (
        "m,t=two\\nlines\\tand\\rmore f=1.0 1609459200000"
    )
    assert text("m", {"b": "2", "a": "1"}, {"z": 1e7, "y": 1e-4}) == (
        "m,a=1,b=2 y=1.0E-4,z=1.0E7 1609459200000"
    )
    assert text("m", {}, {"n": 12, "x": 1.5}) == "m n=12i,x=1.5 1609459200000"
    # Beyond what a double holds exactly.
    assert text("m", {}, {"n": 9007199254740993}) == "m n=9007199254740993i 1609459200000"
    assert text("m", {}, {"n": 1.7}) == "m n=1.7 1609459200000"


def test_escapes_as_a_plain_loop_does(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("ab é,= \\\"'\n\r\t{}[]$1", k=rng.randint(1, 12))) for _ in range(400)]

    def escaped(text, specials):
        named = {"\n": "\\n", "\r": "\\r", "\t": "\\t"}
        return "".join(named.get(c, "\\" + c if c in specials else c) for c in text)

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    tags = F.create_map(F.lit("t"), F.col("t"), F.col("t"), F.lit("v"))
    points = df.select(
        F.col("t").alias("measurement"),
        tags.alias("tags"),
        F.create_map(F.col("t"), F.col("i").cast("double")).alias("fields"),
        F.create_map().cast("map<string,bigint>").alias("int_fields"),
        F.col("i").cast("bigint").alias("time_ms"),
    )
    lines = [r.line for r in gs.points_to_lines(points).collect()]
    for i, (text, line) in enumerate(zip(texts, lines, strict=True)):
        key = escaped(text, ",= ")
        pairs = sorted([("t", f"t={key}"), (text, f"{key}=v")], key=lambda p: p[0].encode())
        series = ",".join([escaped(text, ", "), *[p[1] for p in pairs]])
        assert line == f"{series} {key}={i}.0 {i}"


def test_run_times(spark):
    runs = spark.createDataFrame([(1700000000123, 4567)], "start_ms bigint, duration_ms bigint")
    points = gs.run_time_points(runs, "Q1")
    assert (points.first().fields, points.first().int_fields) == ({}, {"duration": 4567})
    line = gs.points_to_lines(points)
    assert tuples(line) == [("time,app=Q1 duration=4567i 1700000000123",)]


def test_line_files(spark, basic, tmp_path):
    points = gs.zone_year_points(gs.zone_year_stats(basic), "a")
    gs.write_point_lines(points, str(tmp_path / "lines"))
    written = sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect())
    assert written == sorted(r.line for r in gs.points_to_lines(points).collect())
    assert len(written) == 2


@pytest.fixture
def keeper(tmp_path):
    """A writer that notes every batch and close in a file per task attempt."""
    folder = str(tmp_path)

    def factory(fail_first=False):
        class Keeper:
            def __init__(self):
                task = TaskContext.get()
                self.attempt = task.attemptNumber()
                name = f"{folder}/{task.partitionId()}-{self.attempt}.json"
                self.out = open(name, "w")  # noqa: SIM115

            def write(self, points):
                rows = [[p.measurement, p.tags, p.fields, p.time_ms] for p in points]
                self.out.write(json.dumps(rows) + "\n")
                if fail_first and self.attempt == 0:
                    raise OSError("database gone")

            def close(self):
                self.out.write("closed\n")
                self.out.close()

        return Keeper()

    def read():
        return {
            p.stem: p.read_text().splitlines() for p in sorted(tmp_path.iterdir()) if p.suffix == ".json"
        }

    return factory, read


def many_points(spark, n, partitions):
    rows = spark.range(0, n, 1, partitions)
    return gs.to_points(rows, "m", {"f": F.col("id")}, {"app": F.lit("a")}, F.col("id"))


def test_writer_gets_bounded_batches_and_is_closed(spark, keeper):
    factory, read = keeper
    gs.write_points(many_points(spark, 25, 2), factory, batch_size=5)
    files = read()
    assert set(files) == {"0-0", "1-0"}
    sent = []
    for lines in files.values():
        assert lines[-1] == "closed"
        batches = [json.loads(line) for line in lines[:-1]]
        assert all(0 < len(b) <= 5 for b in batches)
        sent += [row[3] for b in batches for row in b]
    assert sorted(sent) == list(range(25))


def test_empty_partitions_open_no_writer(spark, keeper):
    factory, read = keeper
    gs.write_points(many_points(spark, 20, 4).where("time_ms = 3"), factory)
    assert list(read()) == ["0-0"]
    with pytest.raises(ValueError):
        gs.write_points(many_points(spark, 1, 1), factory, batch_size=0)


def test_failed_task_is_sent_again_whole(spark, keeper):
    factory, read = keeper
    gs.write_points(many_points(spark, 20, 2), lambda: factory(fail_first=True), batch_size=4)
    files = read()
    assert set(files) == {"0-0", "0-1", "1-0", "1-1"}
    assert files["0-0"][-1] == "closed" and len(files["0-0"]) == 2
    again = [row[3] for name in ("0-1", "1-1") for line in files[name][:-1] for row in json.loads(line)]
    assert sorted(again) == list(range(20))
