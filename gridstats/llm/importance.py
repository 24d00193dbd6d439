"""Resampling of documents towards a target distribution by importance weights of hashed word runs.

Texts of a batch are joined with a separator, one pass of a regular expression finds the words of all of
them, and the offsets of the texts tell to which text each word belongs; runs of words that cross texts are
masked before buckets are counted. What the raw texts and the target texts have in each bucket gives every
bucket a gain; a text weighs the mean gain of its features. Drawing without replacement is a matter of the
highest scores, weight plus Gumbel noise, ranked without gathering the rows in one place.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.base import fresh, placed
from gridstats.shared import kept

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SEPARATOR = b"\n"  # never part of a word
_BATCH_BYTES = 1 << 20
_LONG = 64  # words of more bytes are hashed one by one


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _zeros_tables(table: np.ndarray, doublings: int = 32) -> list[np.ndarray]:
    """For each k, what 2 ** k zero bytes make of a register, as four tables of its bytes."""
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([values << np.uint32(8 * i) for i in range(4)])
    one = (one >> np.uint32(8)) ^ table[one & 255]
    made = [one]
    for _ in range(doublings - 1):
        last = made[-1]
        made.append(_after(last, last))
    return made


def _after(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    eight = np.uint32(8)
    return (
        tables[0][register & 255]
        ^ tables[1][(register >> eight) & 255]
        ^ tables[2][(register >> (eight * np.uint32(2))) & 255]
        ^ tables[3][register >> (eight * np.uint32(3))]
    )


class Crc32:
    """CRC-32 of many words at once, and of two words with a space between from those of the words."""

    def __init__(self) -> None:
        self.table = _crc_table()
        self.zeros = _zeros_tables(self.table)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        first_short = int(np.searchsorted(-size[order], -_LONG))
        for i in order[:first_short]:
            crc[i] = zlib.crc32(data[starts[i] : ends[i]]) ^ 0xFFFFFFFF
        short = order[first_short:]
        size = size[short]
        at, register = starts[short], crc[short]
        for k in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -k))  # words of more than k bytes come first
            register[:n] = self.table[(register[:n] ^ data[at[:n] + k]) & 255] ^ (register[:n] >> np.uint32(8))
        crc[short] = register
        return ~crc

    def with_space(self, left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
        """CRC-32 of ``left + b" " + right`` from those of both."""
        spaced = ~left
        spaced = ~(self.table[(spaced ^ np.uint32(32)) & 255] ^ (spaced >> np.uint32(8)))
        for k in range(int(right_size.max(initial=0)).bit_length()):
            on = np.flatnonzero((right_size >> k) & 1)
            spaced[on] = _after(self.zeros[k], spaced[on])
        return spaced ^ right


@dataclass(frozen=True)
class Features:
    """Features of a batch of texts: bucket and text of each, words of each text."""

    bucket: np.ndarray
    text: np.ndarray
    n_words: np.ndarray


def batch_features(texts: list[str | None], width: int, buckets: int, crc: Crc32) -> Features:
    """Buckets of all runs of 1 to ``width`` words of every text. Only A-Z is lower-cased."""
    whole = [(t or "").encode().lower() for t in texts]
    offsets = np.cumsum([0, *[len(t) + len(_SEPARATOR) for t in whole]])
    line = _SEPARATOR.join(whole)
    spans = np.array([m.span() for m in _WORD.finditer(line)], np.int64).reshape(-1, 2)
    starts, ends = spans[:, 0], spans[:, 1]
    text = np.searchsorted(offsets, starts, side="right") - 1
    data = np.frombuffer(line, np.uint8)
    hashes, sizes = crc.of(data, starts, ends), ends - starts
    found, owners, run = [hashes], [text], hashes
    for n in range(2, width + 1):
        run = crc.with_space(run[:-1], hashes[n - 1 :], sizes[n - 1 :])
        inside = text[n - 1 :] == text[: len(text) - n + 1]
        found.append(run[inside])
        owners.append(text[n - 1 :][inside])
    bucket = (np.concatenate(found) % np.uint32(buckets)).astype(np.int64)
    return Features(bucket, np.concatenate(owners), np.bincount(text, minlength=len(texts)))


def _slices(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of about a megabyte; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _BATCH_BYTES:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def bucket_counts(docs: DataFrame, text: str = "text", width: int = 2, buckets: int = 10_000) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket; empty buckets have no row."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crc, total = Crc32(), np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in _slices(texts):
                total += np.bincount(batch_features(texts[part], width, buckets, crc).bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    each = docs.select(F.col(text).alias("text")).mapInPandas(count, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class ImportanceModel:
    """The gain of each bucket, in thousandths of a natural logarithm."""

    gains: np.ndarray
    width: int

    def weigh(self, docs: DataFrame, text: str, carried: list[str]) -> DataFrame:
        """``carried`` columns of every row with ``n_words, n_features, weight``."""
        gains, width = self.gains, self.width

        def weights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            crc = Crc32()
            for batch in batches:
                texts = batch["_text"].tolist()
                for part in _slices(texts):
                    got = batch_features(texts[part], width, len(gains), crc)
                    n = part.stop - part.start
                    count = np.bincount(got.text, minlength=n)
                    total = np.bincount(got.text, gains[got.bucket], n).astype(np.int64)
                    made = batch[["_row"]].iloc[part].reset_index(drop=True)
                    yield made.assign(n_words=got.n_words, n_features=count, weight=total // np.maximum(count, 1))

        # In a struct, as a null in a column of whole numbers would make it one of floats.
        source = docs.select(F.struct(*carried).alias("_row"), F.col(text).alias("_text"))
        shape = f"_row {source.schema['_row'].dataType.simpleString()}, n_words long, n_features long, weight long"
        return source.mapInPandas(weights, shape).select("_row.*", "n_words", "n_features", "weight")


def train_importance(
    raw: DataFrame, target: DataFrame, text: str = "text", width: int = 2, buckets: int = 10_000
) -> ImportanceModel:
    """Gains from all texts of ``raw`` and ``target``, one added to each bucket's count.

    The counts reach the driver as ``buckets`` numbers each, whatever the size of the tables.
    """

    def counts(docs: DataFrame) -> np.ndarray:
        n = np.zeros(buckets)
        for row in bucket_counts(docs, text, width, buckets).toLocalIterator():
            n[row["bucket"]] = row["n"]
        return n

    s, t = counts(raw), counts(target)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return ImportanceModel(np.floor(1000 * np.log(ratio)).astype(np.int64), width)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of ``<seed>:<doc_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, 1, 2, 3 ... in the order of the columns.

    Rows are parted by ranges and sorted there; the parts are counted, and the counts before each part, a
    row for each, are added. No task sees more than one range.
    """
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())  # parts rows that are all alike
    parts = spread.repartitionByRange(*order, F.col("_spread")).sortWithinPartitions(*order, "_spread")
    numbered = kept(parts.drop("_spread").withColumn("_number", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_number", 33)
    sizes = numbered.groupBy(part.alias("_of")).agg(F.count("*").alias("n")).collect()  # a row for each task
    before, starts = 0, []
    for row in sorted(sizes, key=lambda r: r["_of"]):
        starts.append((row["_of"], before))
        before += row["n"]
    starts = rows.sparkSession.createDataFrame(starts or [(0, 0)], "_of long, _before long")
    placed_ = numbered.join(F.broadcast(starts), part == F.col("_of"))
    place = F.col("_before") + F.col("_number").bitwiseAND((1 << 33) - 1) + 1
    return placed_.withColumn("place", place).drop("_of", "_before", "_number")


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    share: float = 0.25,
    min_words: int = 20,
    seed: int = 7,
    width: int = 2,
    buckets: int = 10_000,
    doc_id: str = "doc_id",
    text: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: ``doc_id, n_words, n_features, weight, score, rank`` and the ``carried`` columns.

    Words are runs of 0-9, A-Z and all beyond ASCII, A-Z lower-cased; features are all runs of 1 to
    ``width`` words, hashed into ``buckets`` by CRC-32. ``weight`` is the floored mean of the gains of a
    text's features, 0 without any; ``score`` adds Gumbel noise that depends on the id and ``seed`` only.
    Of the rows with ``min_words`` words or more the share ``share`` (rounded down) with the highest scores
    is drawn: ``rank`` is 1, 2, 3 ... in that order, ties to the smaller id, null ids last; null for rows
    not drawn. A null text has no words; a null id counts as an empty one in the noise; equal rows get
    ranks next to each other; an empty table of targets leaves gains that favour rare features; an empty
    table of documents gives no rows. A task holds the features of about a megabyte of text, or of one
    text, about 100 times its bytes.
    """
    model = train_importance(docs, target, text, width, buckets)
    named = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_source"), *carried)
    weighed = model.weigh(named, "_source", ["_doc", *carried])
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("_doc"), seed))
    # Kept first: finding the ranges would weigh every text once more.
    scored = kept(scored, "scores")
    order = [F.col("_unfit"), F.col("score").desc(), F.col("_doc").asc_nulls_last()]
    rows = _ranked(scored.withColumn("_unfit", F.col("n_words") < min_words), order)
    able = rows.agg(F.count_if(~F.col("_unfit"))).first()[0]
    drawn = int(share * able + 1e-9)
    rank = F.when(~F.col("_unfit") & (F.col("place") <= drawn), F.col("place"))
    return rows.select(
        F.col("_doc").alias(doc_id), "n_words", "n_features", "weight", "score", rank.alias("rank"), *carried
    )


def importance_resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are; ``options`` as for ``importance_ranks``."""
    at, place = placed(docs)
    mark = fresh(at, "_drawn_place")
    ranks = importance_ranks(at, target, doc_id=doc_id, text=text, carried=(place,), **options)
    drawn = ranks.where(F.col("rank").isNotNull()).select(F.col(place).alias(mark))
    return at.join(drawn, at[place] == drawn[mark], "left_semi").drop(place)
