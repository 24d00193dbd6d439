"""The first rows of every key in one pass, and joins over bucketed partials."""

import math

import pytest
from pyspark.sql import functions as F

import gridstats as gs
from gridstats.schema import CFE, CI, METRICS, YEAR_MONTH, ZONE
from gridstats.shared import BUCKET_KEY, kept_in_buckets

from conftest import close, final_plan, tuples


def plain(rows, k, column, ascending):
    """First ``k`` months of ``(month, ci, cfe)``: null first ascending, NaN highest, ties by month."""

    def key(row):
        v = row[column]
        rank = (0, 0.0) if v is None else (2, 0.0) if math.isnan(v) else (1, v)
        return rank

    by_month = sorted(rows, key=lambda r: (r[0] is not None, r[0] or ""))
    return sorted(by_month, key=key, reverse=not ascending)[:k] if ascending else sorted(by_month, key=lambda r: tuple(-x for x in key(r)))[:k]


@pytest.mark.parametrize("k", [1, 5, 100])
def test_every_zone_against_plain_lists(random_readings, k):
    got = {}
    for r in gs.zone_extremes(random_readings, k).collect():
        got.setdefault((r.zone_id, r.ranking), []).append((r.place, r.year_month, r[f"avg_{CI}"], r[f"avg_{CFE}"]))
    zones = [r[0] for r in random_readings.select(ZONE).distinct().collect()]
    for zone in zones:
        months = tuples(gs.monthly_averages(random_readings, zone))
        for i, m in enumerate(METRICS, 1):
            for way in ("desc", "asc"):
                expected = plain(months, k, i, way == "asc")
                found = sorted(got[zone, f"{m}_{way}"])
                assert [p for p, *_ in found] == list(range(1, len(expected) + 1))
                assert all(close(f[1:], e) for f, e in zip(found, expected))
    assert len(got) == 4 * len(zones)


def test_nulls_nan_and_ties(spark):
    rows = [("a", m, v) for m, v in [("01", 1.0), ("02", None), ("03", float("nan")), ("04", 1.0), ("05", 0.5), ("06", None)]]
    df = spark.createDataFrame([*rows, (None, "01", 2.0)], "key string, month string, v double").repartition(3)
    lists = {"high": ("v", False), "low": ("v", True)}
    for parts in ([], [F.col("month") < "04"], [F.col("month") % 2, F.lit(1)]):
        got = {}
        for r in gs.top_k_per_key(df, ["key"], lists, 4, "month", parts).orderBy("key", "ranking", "place").collect():
            got.setdefault((r.key, r.ranking), []).append(r.month)
        assert got == {
            ("a", "high"): ["03", "01", "04", "05"],
            ("a", "low"): ["02", "06", "05", "01"],
            (None, "high"): ["01"],
            (None, "low"): ["01"],
        }
    assert gs.top_k_per_key(df.limit(0), ["key"], lists, 4, "month").collect() == []


def test_one_scan_and_no_sort_of_the_whole(spark, random_readings, tmp_path):
    random_readings.write.parquet(str(tmp_path / "p"))
    plan = final_plan(gs.zone_extremes(gs.read_readings(spark, str(tmp_path / "p"))))
    assert plan.count("FileScan") == 1
    for node in ("Window", "rangepartitioning", "Python", "TakeOrdered"):
        assert node not in plan


def test_joins_of_bucketed_partials_move_nothing(spark, random_readings):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(gs.zone_year_stats_joined(random_readings, sort=False))
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucket_keys_keep_nulls_apart(spark):
    rows = [(None, None), (None, 1), ("", None), ("null", 1), ("a", 1)]
    kept = kept_in_buckets(spark.createDataFrame(rows, "a string, b int"), ["a", "b"], buckets=3)
    assert kept.select(BUCKET_KEY).distinct().count() == 5
    assert kept.join(kept.select(BUCKET_KEY, F.col("b").alias("c")), BUCKET_KEY).count() == 5
