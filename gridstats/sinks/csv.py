"""CSV folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridstats.schema import AVERAGES_FOLDER, RANKING_FOLDERS, YEAR_MONTH, ZONE


def write_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists"
) -> None:
    """Write ``df`` as a CSV folder; sorted rows stay sorted over the part files in name order.

    Text is kept as it is, blanks at its ends included. An empty text is read back as null, and a text
    with a line break in it makes the reader fail.
    """
    # A quote within quotes is doubled, and nothing else is an escape.
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    df.write.mode(mode).options(header=header, **plain).csv(path)


def require_absent(spark: SparkSession, *paths: str) -> None:
    """Fail if any path exists: to be asked before a long scan rather than after it."""
    for path in paths:
        try:
            spark.read.text(path)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        raise FileExistsError(path)


def write_monthly_report(
    averages: DataFrame,
    rankings: Mapping[str, DataFrame],
    path: str,
    header: bool = True,
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Write the averages in month order, without the zone, and each ranking beside them.

    Five jobs read ``averages``; see ``plans.reports.monthly_report``, which computes them once. Gives the
    rows that each result had, ``averages`` and the names of the rankings: they are observed as they are
    written, so no result is computed to be counted.
    """
    plot = averages.drop(ZONE).orderBy(YEAR_MONTH)
    folders = {"averages": AVERAGES_FOLDER, **RANKING_FOLDERS}
    sizes = {}
    for name, result in {"averages": plot, **rankings}.items():
        seen = Observation()
        counted = result.observe(seen, F.count(F.lit(1)).alias("n_rows"))
        write_csv(counted, f"{path}/{folders[name]}", header, mode)
        sizes[name] = seen.get["n_rows"]
    return sizes
