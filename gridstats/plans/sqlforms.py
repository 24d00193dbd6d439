"""The queries as SQL text over a view or table.

Column names are quoted; the table's name and values are passed as parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridstats.operators.ranking import RANKINGS
from gridstats.schema import (
    COUNTRY,
    HOME_ZONE,
    METRICS,
    MONTH_FORMAT,
    TOP_K,
    YEAR,
    YEAR_MONTH,
    ZONE,
)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _select_list(metrics: Sequence[str], stats: Sequence[str]) -> str:
    return ", ".join(
        f"{s.upper()}({quote(m)}) AS {quote(f'{s}_{m}')}" for m in metrics for s in stats
    )


def zone_year_stats_sql(
    spark: SparkSession,
    view: str,
    sort: bool = True,
    zone: str = ZONE,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Statistics per zone and year of a view that has a ``year`` column."""
    text = f"""
        SELECT {quote(zone)} AS {COUNTRY}, {YEAR}, {_select_list(metrics, ("avg", "min", "max"))}
        FROM IDENTIFIER(:view)
        GROUP BY {quote(zone)}, {YEAR}
    """
    return spark.sql(text + (f"ORDER BY {COUNTRY}, {YEAR}" if sort else ""), args={"view": view})


def monthly_averages_sql(
    spark: SparkSession,
    view: str,
    zone: str = HOME_ZONE,
    keep_zone: bool = True,
    sort: bool = True,
    zone_column: str = ZONE,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Monthly averages of one zone of a view that has a ``month_start`` column."""
    place = quote(zone_column)
    kept = f"{place} AS {ZONE}, " if keep_zone else ""
    text = f"""
        SELECT date_format(month_start, '{MONTH_FORMAT}') AS {YEAR_MONTH}, {kept}
               {_select_list(metrics, ("avg",))}
        FROM IDENTIFIER(:view)
        WHERE {place} = :zone
        GROUP BY month_start{f", {place}" if keep_zone else ""}
    """
    text += f"ORDER BY {YEAR_MONTH}" if sort else ""
    return spark.sql(text, args={"view": view, "zone": zone})


def top_k_sql(
    spark: SparkSession,
    view: str,
    by: str,
    k: int = TOP_K,
    ascending: bool = False,
    ties: Sequence[str] = (YEAR_MONTH,),
) -> DataFrame:
    """The first ``k`` rows of a view by one column."""
    order = [f"{quote(by)} {'ASC' if ascending else 'DESC'}", *map(quote, ties)]
    text = f"SELECT * FROM IDENTIFIER(:view) ORDER BY {', '.join(order)} LIMIT :k"
    return spark.sql(text, args={"view": view, "k": k})


def monthly_rankings_sql(spark: SparkSession, view: str, k: int = TOP_K) -> dict[str, DataFrame]:
    """The four lists of a view of monthly averages."""
    return {name: top_k_sql(spark, view, by, k, asc) for name, (by, asc) in RANKINGS.items()}
