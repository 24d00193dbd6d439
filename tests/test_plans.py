"""The plans that the queries must keep at scale."""

import re

import pytest
from pyspark.sql import functions as F

import gridstats as gs
from gridstats.schema import CFE, CI, TIME, ZONE

from conftest import final_plan


@pytest.fixture
def stored(spark, random_readings, tmp_path):
    """Readings in Parquet beside a column that nothing needs."""
    random_readings.selectExpr("*", "'x' as other").repartition(6).write.parquet(str(tmp_path / "p"))
    return gs.read_readings(spark, str(tmp_path / "p"))


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def exploded(points):
    return points.select("*", F.explode("fields").alias("field", "value"))


QUERIES = {
    "zone_year": gs.zone_year_stats,
    "zone_year_merged": gs.zone_year_stats_merged,
    "monthly": gs.monthly_averages,
    "monthly_merged": gs.monthly_averages_merged,
    "extremes": lambda df: gs.monthly_extremes(gs.monthly_averages(df), label="ranking"),
    "lines": lambda df: gs.points_to_lines(gs.zone_year_points(gs.zone_year_stats(df, sort=False))),
    "points": lambda df: exploded(gs.zone_year_points(gs.zone_year_stats(df, sort=False))),
    "monthly_points": lambda df: exploded(gs.monthly_points(gs.monthly_averages(df, sort=False))),
}


@pytest.mark.parametrize("name", QUERIES)
def test_one_scan_no_python_no_cross_join(stored, name):
    plan = final_plan(QUERIES[name](stored))
    assert plan.count("FileScan") == 1
    assert "Batched: true" in plan
    for node in ("Python", "Arrow", "Cartesian", "NestedLoop", "Window", "MapPartitions"):
        assert node not in plan


@pytest.mark.parametrize("name", QUERIES)
def test_aggregate_is_reduced_before_its_one_shuffle(stored, name):
    plan = final_plan(QUERIES[name](stored))
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_" in below


def test_only_needed_columns_are_read(stored):
    (columns,) = read_columns(final_plan(gs.zone_year_stats(stored)))
    assert columns == {TIME, ZONE, CI, CFE}
    (columns,) = read_columns(final_plan(gs.zone_year_stats(stored, metrics=[CI])))
    assert columns == {TIME, ZONE, CI}


@pytest.mark.parametrize("name", ["monthly", "monthly_merged", "extremes"])
def test_zone_filter_reaches_the_scan(stored, name):
    assert f"EqualTo({ZONE},IT)" in final_plan(QUERIES[name](stored))


def test_zone_filter_reaches_the_scan_from_sql(spark, stored):
    view = gs.register(gs.with_period(stored, "month_start"), "stored_by_month")
    plan = final_plan(gs.monthly_averages_sql(spark, view))
    assert f"EqualTo({ZONE},IT)" in plan and plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_rankings_do_not_sort_everything(stored):
    plan = final_plan(gs.monthly_extremes(gs.monthly_averages(stored)))
    assert plan.count("TakeOrderedAndProject") == 4
    assert "rangepartitioning" not in plan
    assert plan.count("ReusedExchange") == 3


@pytest.mark.parametrize("name", ["zone_year", "monthly_merged", "lines", "points", "monthly_points"])
def test_time_is_parsed_once_per_reading(stored, name):
    assert final_plan(QUERIES[name](stored)).count("try_cast(datetime_utc") == 1


def test_merged_zone_partition_is_pruned(spark, random_readings, tmp_path):
    """Data laid out by zone: other zones' files are not listed for reading."""
    path = str(tmp_path / "by_zone")
    random_readings.write.partitionBy(ZONE).parquet(path)
    plan = final_plan(gs.monthly_averages(gs.read_readings(spark, path)))
    assert re.search(r"PartitionFilters: \[[^\]]*= IT\)", plan)
