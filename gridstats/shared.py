"""The folder that driver and executors share, for tables between jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@lru_cache
def _temporary_folder(session: str) -> str:
    """One folder for a session, however often it is asked for."""
    return tempfile.mkdtemp(prefix="gridstats-")


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The checkpoint folder: the context's, else the one ``spark.checkpoint.dir`` names, else
    ``fallback``. A session whose executors are threads of the driver, as in tests, may have none of
    these and gets a temporary folder; any other session gets an error."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder or fallback:
        return (folder or fallback).rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _temporary_folder(spark.sparkContext.applicationId)
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str = "table", fallback: str | None = None) -> str:
    """A name in the shared folder that no one has used; within ``scratch``, in its folder."""
    root = _scratch.get() or shared_folder(spark, fallback)
    return f"{root}/gridstats-{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, fallback: str | None = None) -> Iterator[str]:
    """A folder for all tables that are kept within the block, removed when it ends.

    Results that read these tables must be written, or otherwise used up, before that.
    """
    path = new_folder(spark, "scratch", fallback)
    before = _scratch.set(path)
    try:
        yield path
    finally:
        _scratch.reset(before)
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system of its path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def kept(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """``df`` computed once into a Parquet table of the shared folder, and read from there.

    Unlike a cached or locally checkpointed table it survives the loss of any executor, and Spark knows
    its size when it picks joins over it.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BUCKET_KEY = "_key"


def kept_in_buckets(df: DataFrame, keys: Sequence[str], buckets: int = 8, name: str = "buckets") -> DataFrame:
    """``df`` computed once into a table whose files are bucketed and sorted by its keys.

    The table has a column ``_key`` more, a text in which null is a value of its own: a join on equal keys
    goes by plain equality, so Spark sees that both sides lie as the join needs them. The table's name is
    known to this session only; its files are in the shared folder.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    key = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]))
    written = df.withColumn(BUCKET_KEY, key).write.format("parquet").option("path", path)
    written.bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).saveAsTable(table)
    return spark.table(table)
