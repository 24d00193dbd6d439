"""The highest and lowest rows of a result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.operators.stats import period_stats
from gridstats.operators.periods import with_period
from gridstats.schema import AVG_CFE, AVG_CI, METRICS, TIME, TOP_K, YEAR_MONTH, ZONE

# Ranking -> (ranked column, ascending).
RANKINGS = {
    "ci_desc": (AVG_CI, False),
    "ci_asc": (AVG_CI, True),
    "cfe_desc": (AVG_CFE, False),
    "cfe_asc": (AVG_CFE, True),
}


def top_k(
    df: DataFrame,
    by: str,
    k: int = TOP_K,
    ascending: bool = False,
    ties: Sequence[str] = (YEAR_MONTH,),
) -> DataFrame:
    """The first ``k`` rows by one column; equal values in the order of ``ties``.

    Nulls come first ascending and last descending, NaN counts as the highest value.
    """
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(order, *ties).limit(k)


def monthly_rankings(averages: DataFrame, k: int = TOP_K) -> dict[str, DataFrame]:
    """The four lists: highest and lowest months by each metric."""
    return {name: top_k(averages, by, k, asc) for name, (by, asc) in RANKINGS.items()}


def monthly_extremes(averages: DataFrame, k: int = TOP_K, label: str | None = None) -> DataFrame:
    """The four lists under each other, duplicates kept; ``label`` names a column for the list's name."""
    lists = monthly_rankings(averages, k)
    if label:
        lists = {name: df.select(F.lit(name).alias(label), "*") for name, df in lists.items()}
    return reduce(DataFrame.unionByName, lists.values())


def _before(a: Column, b: Column, ascending: bool) -> Column:
    """-1, 0 or 1 as ``a`` comes before, with or after ``b``: nulls first ascending, last descending."""
    less = F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), -1).when(b.isNull(), 1)
    less = less.when(a < b, -1).when(a > b, 1).otherwise(0)
    return less if ascending else -less


def _first_rows(rows: Column, value: str, k: int, ascending: bool) -> Column:
    """The first ``k`` of an array of ``(ties, values)``, equal values by their ties."""

    def order(a: Column, b: Column) -> Column:
        by_value = _before(a[value], b[value], ascending)
        return F.when(by_value != 0, by_value).otherwise(_before(a["tie"], b["tie"], True))

    return F.slice(F.array_sort(rows, order), F.lit(1), F.lit(k))


def top_k_per_key(
    df: DataFrame,
    keys: Sequence[str],
    rankings: Mapping[str, tuple[str, bool]] = RANKINGS,
    k: int = TOP_K,
    tie: str = YEAR_MONTH,
    parts: Sequence[Column] = (),
    label: str = "ranking",
) -> DataFrame:
    """Every ranking's first ``k`` rows of each key: ``keys, ranking, place, tie, values``.

    All rankings come from one pass. Rows of a key are first ranked within the first of ``parts``, an
    expression of ``tie`` or the ranked columns that bounds how many rows one group has; then the ``k`` rows
    left of each go on, without that part, and so on. Nothing is sorted as a whole and no window is used: a
    task holds the rows of one key and part. Without ``parts`` it holds those of one key.
    """
    columns = list(dict.fromkeys(by for by, _ in rankings.values()))
    row = F.struct(F.col(tie).alias("tie"), *columns)
    names = {name: f"_list{i}" for i, name in enumerate(rankings)}
    marks = [f"_part{i}" for i in range(len(parts))]
    found = df.select(*keys, *[p.alias(m) for p, m in zip(parts, marks)], row.alias("_row"))

    def best(rows: Column, name: str) -> Column:
        by, ascending = rankings[name]
        return _first_rows(rows, by, k, ascending).alias(names[name])

    found = found.groupBy(*keys, *marks).agg(F.collect_list("_row").alias("_rows"))
    found = found.select(*keys, *marks, *[best(F.col("_rows"), name) for name in rankings])
    for i in range(1, len(marks) + 1):
        found = found.groupBy(*keys, *marks[i:]).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in names.values()])
        found = found.select(*keys, *marks[i:], *[best(F.col(names[name]), name) for name in rankings])
    lists = F.array(*[F.struct(F.lit(name).alias("name"), F.col(c).alias("rows")) for name, c in names.items()])
    each = found.select(*keys, F.explode(lists).alias("_list"))
    each = each.select(*keys, F.col("_list.name").alias(label), F.posexplode("_list.rows").alias("_at", "_row"))
    return each.select(
        *keys, label, (F.col("_at") + 1).alias("place"), F.col("_row.tie").alias(tie), *[F.col("_row")[c].alias(c) for c in columns]
    )


def zone_extremes(
    df: DataFrame,
    k: int = TOP_K,
    time: str = TIME,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
    on_bad_time: str = "null",
    digits: int | None = None,
) -> DataFrame:
    """The ``k`` highest and lowest months of every zone by each metric, from readings in one scan.

    ``digits`` rounds averages before they are ranked, so that equal ones tie whatever the order of
    summation was. A list is named ``<metric>_desc`` or ``_asc``. The months of a zone are ranked year by year, then the
    ``k`` of each year together: a group has 12 months, then ``k`` for each year.
    """
    months = with_period(df, "month_start", time=time, on_bad_time=on_bad_time)
    averages = period_stats(months, [zone, "month_start"], metrics, ("avg",))
    if digits is not None:
        averages = averages.withColumns({f"avg_{m}": F.round(f"avg_{m}", digits) for m in metrics})
    rankings = {f"{m}_{way}": (f"avg_{m}", way == "asc") for m in metrics for way in ("desc", "asc")}
    ranked = top_k_per_key(averages, [zone], rankings, k, "month_start", [F.year("month_start")])
    label = F.date_format("month_start", "yyyy-MM").alias(YEAR_MONTH)
    return ranked.select(zone, "ranking", "place", label, *[f"avg_{m}" for m in metrics])
