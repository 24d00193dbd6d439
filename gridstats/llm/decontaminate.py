"""Benchmark passages in training documents, by column expressions alone.

Words are runs of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z. Every window of ``size``
consecutive words of a benchmark item (the whole item if it is shorter) is hashed into a set that is
broadcast; the windows of every document are looked up in it, and what matches is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.base import fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SALTS = 1024


def words(text: Column) -> Column:
    """The normalised words of a text; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def _windows(found: Column, size: int) -> Column:
    """Windows of ``size`` words as ``(at, size, h)``, in order."""
    last = F.size(found) - size
    each = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("at"), F.lit(size).alias("size"), F.xxhash64(F.slice(found, i + 1, size)).alias("h")
        ),
    )
    return F.when(last >= 0, each).otherwise(F.array().cast("array<struct<at:int,size:int,h:bigint>>"))


def benchmark_windows(
    benchmark: DataFrame, size: int = 10, item: str = "item_id", text: str = "text"
) -> DataFrame:
    """Distinct windows, ``(size, h, window, items)``; ``items`` are the ids of items that hold one.

    An item without words has no window; one without an id has windows but is named nowhere.
    """
    own = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("words"))
    n = F.least(F.size("words"), F.lit(size))
    own = own.where(F.size("words") > 0).withColumn("n", n)
    windows = own.select(
        "item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - F.col("n") + 1),
                lambda i: F.slice("words", i, F.col("n")),
            )
        ).alias("window"),
    )
    grouped = windows.groupBy("window").agg(F.collect_set("item").alias("items"))
    return grouped.select(
        F.size("window").alias("size"), F.xxhash64("window").alias("h"), "window", "items"
    )


def _scanned(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int,
    doc_id: str,
    text: str,
    item: str,
    broadcast_rows: int,
) -> DataFrame:
    """One row per document id and text: how often it occurs, its words, hit ``(at, size)``, items."""
    known = benchmark_windows(benchmark, size, item)
    # The set and the sizes in it are small and asked for twice: of how many rows, and of which sizes.
    sizes = {r["size"]: r["n"] for r in known.groupBy("size").agg(F.count("*").alias("n")).collect()}
    # A document sends one row of its own besides its hits. It passes the lookup by a marked window of
    # size 0, one of many, so that no key is hot where the set is too large for a broadcast.
    marks = benchmark.sparkSession.range(_SALTS).select(
        F.lit(0).alias("size"),
        F.col("id").alias("h"),
        F.array().cast("array<string>").alias("window"),
        F.array().cast(known.schema["items"].dataType).alias("items"),
    )
    known = known.unionByName(marks)
    small = sum(sizes.values()) <= broadcast_rows
    if small:
        known = F.broadcast(known)

    read = docs.select(
        F.col(doc_id).alias("doc"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"),
        words(F.col(text)).alias("words"),
    )
    mark = F.struct(
        F.lit(-1).alias("at"),
        F.lit(0).alias("size"),
        F.pmod(F.xxhash64("digest"), F.lit(_SALTS)).alias("h"),
    )
    all_windows = F.concat(F.array(mark), *[_windows(F.col("words"), n) for n in sorted(sizes)])
    windows = read.select("doc", "digest", "words", F.explode(all_windows).alias("w"))
    window = F.slice("words", F.greatest(F.col("w.at"), F.lit(0)) + 1, F.col("w.size"))
    # Beside a broadcast set no row moves, and the words are looked at where the hash is found. Rows that
    # are shuffled carry their window, not the words of the document.
    windows = windows.select(
        "doc", "digest", F.size("words").alias("n_words"), "w.at", "w.size", "w.h",
        F.col("words").alias("content") if small else window.alias("content"),
    )
    content = F.col("content")
    if small:
        content = F.slice(content, F.greatest(F.col("at"), F.lit(0)) + 1, F.col("size"))
    hits = windows.join(known, ["size", "h"]).where((F.col("at") < 0) | (content == F.col("window")))
    hits = hits.select(
        "doc",
        "digest",
        "at",
        "size",
        F.when(F.col("at") < 0, F.col("n_words")).alias("n_words"),
        F.when(F.col("at") >= 0, F.col("items")).alias("items"),
    )
    span = F.when(F.col("at") >= 0, F.struct("at", "size"))
    return hits.groupBy("doc", "digest").agg(
        F.count("n_words").alias("copies"),
        F.max("n_words").cast("bigint").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def _covered(spans: Column) -> Column:
    """Words that sorted spans cover."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(so_far: Column, s: Column) -> Column:
        end = s["at"] + s["size"]
        fresh = F.greatest(end - F.greatest(s["at"], so_far["end"]), F.lit(0))
        return F.struct(
            F.greatest(end, so_far["end"]).alias("end"), (so_far["n"] + fresh).alias("n")
        )

    return F.aggregate(spans, start, add, lambda r: r["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items, spans, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window, ``spans`` are the occurrences as
    ``(at, size)`` in words, ``items`` the ids of the items they belong to. A null text has no words; rows
    repeated in ``docs`` are repeated in the result; a null id is an id. The set of windows is broadcast
    up to ``broadcast_rows``; beyond, the windows of the documents are shuffled to it.
    """
    scanned = _scanned(docs, benchmark, size, doc_id, text, item, broadcast_rows)
    counted = scanned.select(
        F.col("doc").alias(doc_id), "n_words", _covered(F.col("spans")).alias("n_hit"), "items", "spans",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy"),
    )
    return counted.drop("_copy").withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    mode: str = "documents",
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """``docs`` without contaminated documents, or with ``mode="spans"`` without the hit words.

    All columns stay as they are. With ``spans`` a hit word goes together with the characters between it
    and the word before.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}: documents or spans")
    scanned = _scanned(docs, benchmark, size, doc_id, text, item, broadcast_rows)
    bad = scanned.where(F.size("spans") > 0).select(
        F.col("doc").alias("_bad_doc"), F.col("digest").alias("_bad_digest"), F.col("spans").alias("_bad_spans")
    )
    digest = F.md5(F.coalesce(docs[text], F.lit("")).cast("binary"))
    same = docs[doc_id].eqNullSafe(bad["_bad_doc"]) & (digest == bad["_bad_digest"])
    if mode == "documents":
        return docs.join(bad, same, "left_anti")
    joined = docs.join(bad, same, "left")
    # A column of its own, so that it is made once per text and not once per piece.
    name = fresh(docs, "_pieces")
    hit_text = F.when(F.col("_bad_spans").isNotNull(), F.col(text))
    joined = joined.withColumn(name, F.regexp_extract_all(hit_text, F.lit(f"({_PIECE})"), F.lit(1)))
    pieces = F.col(name)
    tail = F.regexp_extract(F.col(text), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$", 0)
    spans = F.col("_bad_spans")
    hit = F.array_distinct(
        F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1)))
    )
    stays = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), hit)
    clean = F.concat(F.array_join(F.transform(stays, lambda i: F.get(pieces, i)), ""), tail)
    cut = F.when(spans.isNull(), F.col(text)).otherwise(clean)
    return joined.select(*[cut.alias(c) if c == text else docs[c] for c in docs.columns])


def item_list(items: Column) -> Column:
    """Ids as text, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ",")
