"""Reading the readings table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.functions.times import parse_time
from gridstats.schema import READING_COLUMNS, READINGS, TIME
from gridstats.shared import new_folder


def read_readings(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    header: bool = False,
    mode: str = "FAILFAST",
    columns: Sequence[str] = READING_COLUMNS,
    strict: bool = False,
) -> DataFrame:
    """Readings at ``path``, any URI or list of URIs that Spark can read.

    Parquet columns are picked by name and keep their types. CSV columns are taken by position, with
    the fixed schema, so the file is never read to infer it; ``mode`` says whether a bad number gives
    null (``PERMISSIVE``) or stops the job (``FAILFAST``). Only what a job needs is parsed: by default a
    bad value of a column that is not used, or of a row that a filter takes out, goes unnoticed. With
    ``strict`` every value of every row is parsed and ``FAILFAST`` stops at any bad one.
    """
    if fmt == "parquet":
        paths = [path] if isinstance(path, str) else list(path)
        return spark.read.parquet(*paths).select(*columns)
    if fmt == "csv":
        reader = spark.read.schema(READINGS).options(header=header, mode=mode, escape='"')
        rows = reader.csv(path if isinstance(path, str) else list(path))
        if strict:
            # An observed column is read whoever asks, and before any filter.
            counts = [F.count(c).alias(c) for c in READINGS.names]
            rows = rows.observe(f"readings-{uuid.uuid4().hex}", *counts)
        return rows.select(*columns)
    raise ValueError(f"unknown format {fmt!r}: parquet or csv")


_NEVER = "\x01"  # a separator that no line has, so that a line comes as one column


def split_readings(
    spark: SparkSession,
    path: str | Sequence[str],
    header: bool = False,
    out: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """CSV readings that are whole, and the lines that are not: ``(readings, rejected)``.

    ``rejected`` has ``line``, as it stands in the file, and ``reason``: ``fields`` (too few or too many),
    the name of a metric that is no number, or the name of the time that has another form than
    ``yyyy-MM-dd HH:mm:ss``; the first that applies. An empty metric or time is null, not bad. Every line is
    read and parsed once, when this is called: both outputs are written in one pass, below ``out`` or in the
    shared folder, and read from there.
    """
    lines = spark.read.schema("line string").options(header=header, sep=_NEVER, quote="", mode="PERMISSIVE")
    lines = lines.csv(path if isinstance(path, str) else list(path))
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in READINGS)
    text = ", ".join(f"{f.name} string" for f in READINGS)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"'}
    parsed = lines.withColumn("_read", F.from_csv("line", f"{typed}, _bad string", options))
    time = F.col(f"_read.{TIME}")
    bad_time = time.isNotNull() & parse_time(time).isNull()

    # Only a line that was refused is looked at again, as text, for what is wrong with it.
    again = F.from_csv("line", f"{text}, _bad string", options)
    why = F.when(again["_bad"].isNotNull(), "fields")
    for field in READINGS:
        if field.dataType.simpleString() != "string":
            why = why.when(
                again[field.name].isNotNull() & again[field.name].try_cast(field.dataType).isNull(), field.name
            )
    refused = F.col("_read._bad").isNotNull()
    reason = F.when(refused, why.otherwise("fields")).when(bad_time, TIME)
    rows = parsed.withColumn("reason", reason)
    kept_line = F.when(F.col("reason").isNotNull(), F.col("line")).alias("line")
    good = [F.when(F.col("reason").isNull(), F.col(f"_read.{c}")).alias(c) for c in READINGS.names]
    rows = rows.select(*good, kept_line, "reason", F.col("reason").isNotNull().alias("is_rejected"))
    out = out or new_folder(spark, "readings")
    rows.write.partitionBy("is_rejected").parquet(out)
    shape = f"{typed}, line string, reason string, is_rejected boolean"
    read = spark.read.schema(shape).parquet(out)
    return (
        read.where("NOT is_rejected").select(*READINGS.names),
        read.where("is_rejected").select("line", "reason"),
    )


def register(df: DataFrame, name: str) -> str:
    """Make ``df`` a table for SQL text; gives the name back."""
    df.createOrReplaceTempView(name)
    return name
