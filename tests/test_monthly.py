import pytest
from pyspark.sql import functions as F

import gridstats as gs
from gridstats.operators import RANKINGS
from gridstats.schema import AVG_CFE, AVG_CI, YEAR_MONTH, ZONE

from conftest import close, tuples


def by_month(df):
    return gs.register(gs.with_period(df, "month_start"), "by_month")


FORMS = {
    "one pass": lambda df, zone: gs.monthly_averages(df, zone),
    "merged": lambda df, zone: gs.monthly_averages_merged(df, zone),
    "sql": lambda df, zone: gs.monthly_averages_sql(
        df.sparkSession, by_month(df), zone, keep_zone=False
    ),
}


@pytest.mark.parametrize("form", FORMS)
def test_months(basic, form):
    averages = FORMS[form](basic, "IT")
    assert averages.columns == [YEAR_MONTH, AVG_CI, AVG_CFE]
    assert tuples(averages) == [("2021-01", 150.0, 50.0), ("2021-02", 300.0, 20.0)]
    assert tuples(FORMS[form](basic, "XX")) == []
    assert tuples(FORMS[form](basic, "' or 1=1 --")) == []


@pytest.mark.parametrize("form", FORMS)
def test_unreadable_time_is_a_month_of_its_own(make, form):
    df = make(("bad", "IT", 3.0, 4.0), ("2021-01-01 00:00:00", "IT", 1.0, None))
    assert tuples(FORMS[form](df, "IT")) == [(None, 3.0, 4.0), ("2021-01", 1.0, None)]


def test_keep_zone(basic):
    expected = [("2021-01", "IT", 150.0, 50.0), ("2021-02", "IT", 300.0, 20.0)]
    assert tuples(gs.monthly_averages(basic, keep_zone=True)) == expected
    sql = gs.monthly_averages_sql(basic.sparkSession, by_month(basic))
    assert tuples(sql) == expected and sql.columns[1] == ZONE
    renamed = basic.withColumnRenamed(ZONE, "place")
    kept = gs.monthly_averages(renamed, zone_column="place", keep_zone=True)
    assert tuples(kept) == expected and kept.columns[1] == ZONE
    sql = gs.monthly_averages_sql(basic.sparkSession, by_month(renamed), zone_column="place")
    assert tuples(sql) == expected and sql.columns[1] == ZONE


def test_forms_agree(random_readings):
    expected = tuples(gs.monthly_averages(random_readings))
    assert len(expected) == 28 and expected == sorted(expected)
    for form in FORMS.values():
        got = tuples(form(random_readings, "IT"))
        assert all(close(a, b) for a, b in zip(got, expected, strict=True))


def months(spark, *rows):
    return spark.createDataFrame(list(rows), f"{YEAR_MONTH} string, {AVG_CI} double, {AVG_CFE} double")


def top_sql(df, *args):
    return gs.top_k_sql(df.sparkSession, gs.register(df, "months"), *args)


@pytest.mark.parametrize("top", [gs.top_k, top_sql])
def test_ties_go_by_month(spark, top):
    df = months(spark, *[(f"2021-0{m}", 5.0, float(m)) for m in (7, 3, 1, 2, 6, 5, 4)])
    first = [f"2021-0{m}" for m in range(1, 6)]
    for ascending in (True, False):
        assert [r[0] for r in tuples(top(df, AVG_CI, 5, ascending))] == first
    assert [r[0] for r in tuples(top(df, AVG_CFE, 2))] == ["2021-07", "2021-06"]


@pytest.mark.parametrize("top", [gs.top_k, top_sql])
def test_null_and_nan_order(spark, top):
    df = months(spark, ("a", None, 0.0), ("b", float("nan"), 0.0), ("c", 1.0, 0.0), ("d", -1.0, 0.0))
    assert [r[0] for r in tuples(top(df, AVG_CI, 4, True))] == ["a", "d", "c", "b"]
    assert [r[0] for r in tuples(top(df, AVG_CI, 4, False))] == ["b", "c", "d", "a"]


def test_top_k_is_the_head_of_the_full_sort(random_readings):
    averages = gs.monthly_averages(random_readings)
    rows = tuples(averages)
    for name, ranking in gs.monthly_rankings(averages, 7).items():
        by, ascending = RANKINGS[name]
        at = averages.columns.index(by)
        full = sorted(rows, key=lambda r: (r[at] if ascending else -r[at], r[0]))
        got = tuples(ranking)
        assert all(close(a, b) for a, b in zip(got, full[:7], strict=True))


def test_fewer_months_than_k_keep_duplicates(spark):
    df = months(spark, ("2021-01", 1.0, 9.0), ("2021-02", 2.0, 8.0), ("2021-03", 3.0, 7.0))
    extremes = gs.monthly_extremes(df)
    assert extremes.columns == df.columns and extremes.count() == 12
    labelled = gs.monthly_extremes(df, k=1, label="ranking")
    assert sorted((r.ranking, r.year_month) for r in labelled.collect()) == [
        ("cfe_asc", "2021-03"), ("cfe_desc", "2021-01"), ("ci_asc", "2021-01"), ("ci_desc", "2021-03"),
    ]


def test_sql_rankings_agree(random_readings, spark):
    averages = gs.monthly_averages(random_readings)
    view = gs.register(averages, "averages")
    ours, theirs = gs.monthly_rankings(averages), gs.monthly_rankings_sql(spark, view)
    assert ours.keys() == theirs.keys()
    for name in ours:
        assert tuples(ours[name]) == tuples(theirs[name])


def test_quoted_names(spark, basic):
    odd = basic.withColumnsRenamed({ZONE: "zone `id`", "carbon_free_energy_percentage_cfe": "c f e"})
    view = gs.register(gs.with_period(odd, "year"), "odd_view")
    got = gs.zone_year_stats_sql(spark, view, zone="zone `id`", metrics=["c f e"])
    assert tuples(got) == [("IT", 2021, 40.0, 20.0, 60.0), ("SE", 2022, 90.0, 90.0, 90.0)]


def test_report_is_computed_once(spark, basic):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    counted = basic.mapInArrow(count, basic.schema)
    report = gs.monthly_report(gs.monthly_averages(counted))
    assert seen.value == 4
    assert dict(tuples(gs.result_sizes({"averages": report.averages, **report.rankings}))) == {
        "averages": 2, "ci_desc": 2, "ci_asc": 2, "cfe_desc": 2, "cfe_asc": 2,
    }
    assert tuples(report.averages.agg(F.count("*"))) == [(2,)]
    assert seen.value == 4
