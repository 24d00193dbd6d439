"""Exact duplicates by a stateful stream.

A stream reads the digests of the documents. Its state, kept in RocksDB and never expired, holds for every
digest the smallest identifier seen, the place of that row's content and a count. Rows whose digest is
shared are hits: their full bytes are then compared with those at the kept place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.base import placed, row_order, without
from gridstats.shared import kept, new_folder

# The state on disk; stores of few rows reserve no space ahead and save what changed.
_STORE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    """A text with each run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def keyed_state(digests: DataFrame, path: str, work: str, batch_bytes: int) -> DataFrame:
    """Run the stream over ``digests (key, row)`` as written at ``path`` and give the last state of each
    key: ``key, first, n``.

    Rows of a key are reduced in every task before they meet the state, so a text that is a third of all
    rows sends one row per task. The stream ends when it has read what is there; its checkpoint is
    in ``work``, from where it goes on with files that are added later.
    """
    spark = digests.sparkSession
    updates = f"{work}/updates"
    shape = digests.groupBy("key").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    shape.limit(0).write.mode("overwrite").parquet(f"{updates}/batch=-1")

    stream = (
        spark.readStream.schema(digests.schema)
        .option("maxBytesPerTrigger", batch_bytes)
        .parquet(path)
    )
    state = stream.groupBy("key").agg(F.min("row").alias("first"), F.count("*").alias("n"))

    def keep(batch: DataFrame, number: int) -> None:
        # The same folder if the batch runs again.
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        running = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{work}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    running.awaitTermination()
    # Of several updates of a key the last has the smallest row and the largest count.
    written = spark.read.schema(shape.schema).parquet(updates).select("key", "first", "n")
    return written.groupBy("key").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def _classes(
    docs: DataFrame,
    place: str,
    doc_id: str,
    text: str,
    digest: Callable[[Column], Column],
    batch_bytes: int,
) -> DataFrame:
    """Per row: ``row, first, n, sha``; ``row`` and ``first`` as ``row_order`` makes them."""
    spark = docs.sparkSession
    row = row_order(F.col(doc_id), F.col(place)).alias("row")
    rows = docs.select(row, F.sha2(normalised(F.col(text)), 256).alias("sha"))
    path = new_folder(spark, "digests")
    rows = kept(rows.select("row", "sha", digest(F.col("sha")).alias("key")), path=path)
    state = kept(keyed_state(rows, path, new_folder(spark, "stream"), batch_bytes), "state")
    known = rows.join(state, "key")
    alone = known.where(F.col("n") == 1).select("row", "first", "n", "sha")

    # Hits: the bytes of every row that shares its digest, from its place, beside those of the kept row.
    shared = known.where(F.col("n") > 1).select("key", "sha", "row", "first")
    content = docs.select(F.col(place).alias("at"), normalised(F.col(text)).alias("content"))
    hits = shared.join(content, F.col("row.place") == F.col("at")).drop("at")
    hits = kept(hits, "hits")
    firsts = hits.where(F.col("row") == F.col("first"))
    firsts = firsts.select("key", F.col("content").alias("first_content"))
    # Another text under the same digest makes a class of its own.
    other = F.when(F.col("content") != F.col("first_content"), F.col("content"))
    compared = hits.join(firsts, "key").select("key", "sha", "row", other.alias("other"))
    compared = kept(compared, "compared")
    classes = compared.groupBy("key", "other").agg(
        F.min("row").alias("first"), F.count("*").alias("n")
    )
    named = classes.select(F.col("key").alias("k"), F.col("other").alias("o"), "first", "n")
    same = (F.col("key") == F.col("k")) & F.col("other").eqNullSafe(F.col("o"))
    return alone.unionByName(compared.join(named, same).select("row", "first", "n", "sha"))


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = lambda sha: sha,
    batch_bytes: int = 64 << 30,
) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are the same after each run of blanks became one space; null counts as empty.
    Of equal texts the row with the smallest id stays, rows without an id after all others, and of rows
    of one id the first in its file; exactly one row of a group has ``kept``. ``digest`` makes the key of
    the state from the SHA-256; two texts of one key are told apart by their bytes. ``batch_bytes`` bounds
    what one micro-batch reads of the digests.
    """
    at, place = placed(docs)
    rows = _classes(at, place, doc_id, text, digest, batch_bytes)
    return rows.select(
        F.col("row.id").alias(doc_id),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_bytes: int = 64 << 30
) -> DataFrame:
    """``docs`` with the row that stays of each group, all columns as they are."""
    at, place = placed(docs)
    rows = _classes(at, place, doc_id, text, lambda sha: sha, batch_bytes)
    dropped = rows.where(F.col("row") != F.col("first")).select(F.col("row.place").alias("gone"))
    return without(at, place, dropped, "gone")
