"""Statistics per key: in one pass, as mergeable partials, and joined from separate results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.schema import METRICS

_STATS = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
# How two partial values of one key become one.
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def period_stats(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str] = METRICS,
    stats: Sequence[str] = ("avg", "min", "max"),
) -> DataFrame:
    """``stats`` of every metric per key, named ``<stat>_<metric>``.

    One aggregate over one scan. Each task first reduces its rows to one row per key it saw, so a key
    that holds most of the readings sends no more rows through the shuffle than any other.
    """
    columns = [_STATS[s](F.col(m)).alias(f"{s}_{m}") for m in metrics for s in stats]
    return df.groupBy(*keys).agg(*columns)


def period_sums(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Sum and count of every metric per key: partials that can be kept and merged later."""
    return period_stats(df, keys, metrics, stats=("sum", "count"))


def merge_partials(
    partials: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str] = METRICS,
    stats: Sequence[str] = ("sum", "count"),
) -> DataFrame:
    """Merge partials of separate inputs, or of finer keys, into one row per key."""
    names = [(s, f"{s}_{m}") for m in metrics for s in stats]
    return partials.groupBy(*keys).agg(*[_MERGE[s](F.col(n)).alias(n) for s, n in names])


def finish_averages(sums: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Turn ``sum_<m>`` and ``count_<m>`` into ``avg_<m>``; other columns stay. No values, no average."""
    counts = {f"count_{m}" for m in metrics}
    averages = {
        f"sum_{m}": F.try_divide(F.col(f"sum_{m}"), F.col(f"count_{m}")).alias(f"avg_{m}")
        for m in metrics
    }
    return sums.select(*[averages.get(c, F.col(c)) for c in sums.columns if c not in counts])


def join_stats(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of statistics computed apart, on equal keys; a null key equals a null key."""
    return reduce(lambda left, right: _join(left, right, keys), frames)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    added = [c for c in right.columns if c not in keys]
    clash = set(added) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    matches = [_of("l", k).eqNullSafe(_of("r", k)) for k in keys]
    joined = left.alias("l").join(right.alias("r"), reduce(Column.__and__, matches), "inner")
    return joined.select(*[_of("l", c) for c in left.columns], *[_of("r", c) for c in added])


def _of(side: str, column: str) -> Column:
    return F.col(f"{side}.`{column}`")


def result_sizes(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every result, as ``(name, n_rows)``; no row reaches the driver."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)
