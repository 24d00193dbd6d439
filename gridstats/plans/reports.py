"""Whole reports: compute once, then write CSV and points from the kept result."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gridstats.operators.points import monthly_points, zone_year_points
from gridstats.operators.ranking import monthly_rankings
from gridstats.schema import AVERAGES_FOLDER, COUNTRY, RANKING_FOLDERS, TOP_K, YEAR
from gridstats.shared import kept, new_folder, remove_folder
from gridstats.sinks.csv import require_absent, write_csv, write_monthly_report
from gridstats.sinks.publish import publication
from gridstats.sinks.points import PointWriter, write_points


@dataclass(frozen=True)
class MonthlyReport:
    averages: DataFrame
    rankings: dict[str, DataFrame]


def monthly_report(averages: DataFrame, k: int = TOP_K, path: str | None = None) -> MonthlyReport:
    """Averages computed once, when this is called, and the four rankings over them.

    The averages are kept at ``path``, or in a new place in the shared folder.
    """
    once = kept(averages, "averages", path)
    return MonthlyReport(once, monthly_rankings(once, k))


def save_zone_year_report(
    stats: DataFrame,
    path: str,
    writer_factory: Callable[[], PointWriter] | None = None,
    app: str | None = None,
    header: bool = True,
    fields: Mapping[str, str] | None = None,
) -> None:
    """Write zone-year statistics sorted to ``path`` and, given a writer, as points.

    ``fields`` as for ``zone_year_points``. What is kept in the shared folder meanwhile is removed.
    """
    require_absent(stats.sparkSession, path)
    with _once(stats, "stats") as once:
        points = None if writer_factory is None else zone_year_points(once, app, fields)
        write_csv(once.orderBy(COUNTRY, YEAR), path, header)
        if points is not None:
            write_points(points, writer_factory)


def save_monthly_report(
    averages: DataFrame,
    path: str,
    writer_factory: Callable[[], PointWriter] | None = None,
    app: str | None = None,
    k: int = TOP_K,
    header: bool = True,
    fields: Mapping[str, str] | None = None,
    manifest: bool = False,
) -> dict[str, int]:
    """Write monthly averages and the four rankings under ``path`` and, given a writer, as points.

    The five folders are written aside and appear together at the end, after the points are delivered; if
    any job fails none of them is there, and the report can be written again. ``manifest`` adds
    ``_manifest.json``, last of all (see ``read_manifest``). ``fields`` as for ``monthly_points``. What is
    kept in the shared folder meanwhile is removed. Gives the rows of each result, as they were written.
    """
    folders = {"averages": AVERAGES_FOLDER, **RANKING_FOLDERS}
    listed: dict[str, int] | None = {} if manifest else None
    with publication(averages.sparkSession, path, list(folders.values()), listed) as staging:
        with _once(averages, "averages") as once:
            points = None if writer_factory is None else monthly_points(once, app, fields)
            sizes = write_monthly_report(once, monthly_rankings(once, k), staging, header)
            if listed is not None:
                listed.update({folders[name]: n for name, n in sizes.items()})
            if points is not None:
                write_points(points, writer_factory)
    return sizes


@contextmanager
def _once(result: DataFrame, name: str) -> Iterator[DataFrame]:
    """A small result computed once; no job of a report reads the input again, and all see the same sums."""
    spark = result.sparkSession
    path = new_folder(spark, name)
    try:
        yield kept(result, path=path)
    finally:
        remove_folder(spark, path)
