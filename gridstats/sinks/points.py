"""Delivery of points to a time-series database or to text files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import Protocol

from pyspark.sql import DataFrame, Row

from gridstats.operators.points import points_to_lines


class PointWriter(Protocol):
    def write(self, points: list[Row]) -> None:
        """Send rows ``(measurement, tags, fields, int_fields, time_ms)``; return when they are stored.

        ``fields`` holds floats, ``int_fields`` ints.
        """

    def close(self) -> None: ...


def write_points(
    points: DataFrame, writer_factory: Callable[[], PointWriter], batch_size: int = 5000
) -> None:
    """Send the points of every partition through a writer opened in the task.

    A partition is sent in batches of at most ``batch_size`` rows, so a task holds one batch at a time;
    an empty partition opens no writer. A task that is run again sends its points again: a database
    that identifies a point by series and time overwrites them.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")

    # Nested, so that it is shipped with the task and workers need not import this package.
    def send(rows: Iterator[Row]) -> None:
        writer = None
        try:
            while batch := list(islice(rows, batch_size)):
                if writer is None:
                    writer = writer_factory()
                writer.write(batch)
        finally:
            if writer is not None:
                writer.close()

    points.foreachPartition(send)


def write_point_lines(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write line protocol text files, made by expressions alone."""
    points_to_lines(points).write.mode(mode).text(path)
