"""Runs of rows: what a few megabytes of texts ask of a large table is asked once for all of them.

A run gets a number that no other has; what its rows hold in common (pairs of tokens, n-grams) is made
distinct within the run, counted or looked up by joins, and comes back to the run as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData

from gridstats.shared import new_folder


def run_number(sequence: int) -> int:
    """A number for the ``sequence``-th run of this task; tasks of one stage share none."""
    return (TaskContext.get().partitionId() << 32) + sequence


def runs(batches: Iterator[pd.DataFrame], text: str, size: int) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows gathered until their texts have ``size`` characters, with the run's number."""
    held, held_size, sequence = [], 0, 0
    for batch in batches:
        start = 0
        for i, n in enumerate(batch[text].str.len().fillna(0).astype(int)):
            held_size += n + 32
            if held_size >= size:
                held.append(batch.iloc[start : i + 1])
                yield run_number(sequence), pd.concat(held, ignore_index=True)
                held, held_size, start, sequence = [], 0, i + 1, sequence + 1
        if start < len(batch):
            held.append(batch.iloc[start:])
    if held:
        yield run_number(sequence), pd.concat(held, ignore_index=True)


def kept_runs(made: DataFrame, n_buckets: int, name: str) -> DataFrame:
    """Rows of runs written once, in files bucketed by ``run``: a cogroup by run then shuffles none of them.

    The table's name is known to this session only; its files are in the shared folder.
    """
    spark = made.sparkSession
    path = new_folder(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    writer = made.write.format("parquet").option("path", path).option("compression", "zstd")
    writer.bucketBy(n_buckets, "run").saveAsTable(table)
    return spark.table(table)


def by_bucket(parts: DataFrame, buckets: int) -> GroupedData:
    """Rows grouped by ``bucket``, in as many tasks as there are buckets: the number of buckets grows with the
    input, where that of shuffle partitions need not, and a task reads one or a few."""
    return parts.repartition(buckets, "bucket").groupBy("bucket")


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers with a byte in front that tells their width."""
    most = int(values.max()) if len(values) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)
