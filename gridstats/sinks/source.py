"""Points through a data source of Spark: tasks report what they wrote, the driver commits or aborts.

The classes run in Python workers and are shipped by value, so that executors need not have the package.
"""

from __future__ import annotations

import base64
import json
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from gridstats.operators.points import points_to_lines

cloudpickle.register_pickle_by_value(sys.modules[__name__])

POINT_FORMAT = "gridstats_points"
# Schemes of Hadoop file systems, and what the file client of the tasks calls them.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file", "": "file"}


def _client(path: str):
    """The file client for a path, and the path as it has it."""
    from pyarrow import fs

    scheme, found, rest = path.partition(":/")
    if not found:
        scheme, rest = "", path
    if scheme not in _SCHEMES:
        raise ValueError(f"no client for {scheme}: paths")
    if _SCHEMES[scheme] == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:/{rest}")


@dataclass
class Written(WriterCommitMessage):
    partition: int
    n_points: int
    n_batches: int
    file: str | None = None


class _Writer(DataSourceWriter):
    """Batches of every task to files or to a client; one record for each task once all are done."""

    def __init__(self, path: str, factory: str | None, batch_size: int, overwrite: bool):
        self.path, self.factory, self.batch_size = path, factory, batch_size
        self.job, self.overwrite = uuid.uuid4().hex, overwrite

    def write(self, iterator: Iterator[Row]) -> Written:
        partition = TaskContext.get().partitionId()
        if self.factory is not None:
            return self._deliver(partition, iterator)
        store, folder = _client(self.path)
        name = f"part-{partition:05d}-{uuid.uuid4().hex}.txt"
        n, batches, out = 0, 0, None
        try:
            while batch := list(islice(iterator, self.batch_size)):
                if out is None:
                    store.create_dir(f"{folder}/pending/{self.job}")
                    out = store.open_output_stream(f"{folder}/pending/{self.job}/{name}")
                out.write("".join(f"{row[0]}\n" for row in batch).encode())
                n, batches = n + len(batch), batches + 1
        finally:
            if out is not None:
                out.close()
        return Written(partition, n, batches, name if n else None)

    def _deliver(self, partition: int, iterator: Iterator[Row]) -> Written:
        open_writer = cloudpickle.loads(base64.b64decode(self.factory))
        n, batches, writer = 0, 0, None
        try:
            while batch := list(islice(iterator, self.batch_size)):
                writer = writer or open_writer()
                writer.write(batch)
                n, batches = n + len(batch), batches + 1
        finally:
            if writer is not None:
                writer.close()
        return Written(partition, n, batches)

    def commit(self, messages: list[Written | None]) -> None:
        """Files of this job take their place, those of earlier ones go if they are overwritten."""
        store, folder = _client(self.path)
        done = [m for m in messages if m is not None]
        if self.overwrite:
            for part in ("lines", "commits"):
                self._clear(store, f"{folder}/{part}")
        for part in ("lines", "commits"):
            store.create_dir(f"{folder}/{part}")
        for m in done:
            if m.file:
                store.move(f"{folder}/pending/{self.job}/{m.file}", f"{folder}/lines/{m.file}")
        self._clear(store, f"{folder}/pending/{self.job}")
        rows = [{"job": self.job, "partition": m.partition, "n_points": m.n_points, "n_batches": m.n_batches} for m in done]
        with store.open_output_stream(f"{folder}/commits/{self.job}.json") as out:
            out.write("".join(json.dumps(r) + "\n" for r in rows).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _client(self.path)
        self._clear(store, f"{folder}/pending/{self.job}")

    @staticmethod
    def _clear(store, folder: str) -> None:
        from pyarrow import fs

        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class PointSink(DataSource):
    """``df.write.format("gridstats_points")``, of one text column of lines, or of points if a client is given.

    Options: ``path``, a folder for what is written and for the record of commits; ``factory``, a pickled
    writer factory in base64 (``save_points`` makes it); ``batch_size``.
    """

    @classmethod
    def name(cls) -> str:
        return POINT_FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if "path" not in self.options:
            raise ValueError("option path is missing")
        batch_size = int(self.options.get("batch_size", 5000))
        if batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        return _Writer(self.options["path"], self.options.get("factory"), batch_size, overwrite)


def save_points(
    points: DataFrame,
    path: str,
    writer_factory: Callable | None = None,
    batch_size: int = 5000,
    mode: str = "append",
) -> None:
    """Write points as files of line protocol below ``path`` or, given a writer, through it.

    Files are all there or none: tasks write aside, and the commit on the driver moves what the tasks that
    count have written. An aborted job leaves nothing. A client gets a point at least once, as with
    ``write_points``. Either way a commit leaves a record for each task, see ``read_commits``; ``mode``
    ``overwrite`` replaces files and records of earlier jobs.
    """
    spark = points.sparkSession
    spark.dataSource.register(PointSink)
    rows, options = points, {"path": path, "batch_size": batch_size}
    if writer_factory is None:
        rows = points_to_lines(points)
    else:
        options["factory"] = base64.b64encode(cloudpickle.dumps(writer_factory)).decode()
    rows.write.format(POINT_FORMAT).mode(mode).options(**options).save()


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """``job, partition, n_points, n_batches`` of the tasks of every committed job."""
    return spark.read.schema("job string, partition int, n_points long, n_batches long").json(f"{path}/commits")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that committed jobs left in files."""
    return spark.read.text(f"{path}/lines").withColumnRenamed("value", "line")
