"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.shared import kept

_PIECE = 1 << 20
_SLICES = 64


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of an id as text leaves ``part`` when divided by ``parts``; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


@dataclass(frozen=True)
class Grams:
    """Hashed n-grams of the characters of a lower-cased text with a blank at both ends."""

    shortest: int = 3
    longest: int = 6
    bits: int = 18

    def mark(self, text: str | None, seen: np.ndarray) -> np.ndarray:
        """Distinct features of a text, in order. ``seen``: 2 ** bits times false, and so it is left."""
        data = f" {(text or '').lower()} ".encode("utf-32-le")
        everything = np.frombuffer(data, np.uint32) * np.uint32(0x9E3779B1)
        for start in range(0, max(1, len(everything) - self.longest), _PIECE):
            rolled = chars = everything[start : start + _PIECE + self.longest]
            for n in range(2, self.longest + 1):
                rolled = rolled[:-1] * np.uint32(0x01000193) + chars[n - 1 :]
                if n >= self.shortest and len(rolled):
                    mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
                    seen[mixed >> np.uint32(32 - self.bits)] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        return found


@dataclass(frozen=True)
class ToxicityModel:
    grams: Grams
    weights: np.ndarray  # classifier's weight times log-count ratio, by feature
    bias: float

    def score(self, text: Column) -> Column:
        """Between 0 and 1; null counts as empty."""
        grams, weights, bias = self.grams, self.weights, self.bias

        @F.pandas_udf(T.DoubleType())
        def score(texts: pd.Series) -> pd.Series:
            seen = np.zeros(1 << grams.bits, bool)
            sums = [bias + float(weights[grams.mark(t, seen)].sum()) for t in texts]
            return pd.Series(1.0 / (1.0 + np.exp(-np.clip(sums, -500, 500))), dtype="float64")

        return score(text)


def log_count_ratios(train: DataFrame, grams: Grams, smoothing: float) -> tuple[np.ndarray, int, int]:
    """The ratio of every feature over all of ``train (text, toxic)``, and the documents of each class.

    Counts are of documents. A feature's pseudo-counts follow its rate in both classes together, so that
    rare features have a ratio near 0 whatever the sizes of the classes.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 1 << grams.bits
        seen, counts, n = np.zeros(size, bool), np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                n[toxic] += 1
                counts[toxic][grams.mark(text, seen)] += 1
        if n.any():
            each = [np.ascontiguousarray(c).tobytes() for c in np.split(counts, _SLICES, axis=1)]
            yield pd.DataFrame({"slice": range(_SLICES), "counts": each, "n0": n[0], "n1": n[1]})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in parts["counts"])
        sums = parts[["n0", "n1"]].sum()
        return pd.DataFrame(
            {"slice": [parts["slice"][0]], "counts": [total.tobytes()], "n0": sums["n0"], "n1": sums["n1"]}
        )

    shape = "slice long, counts binary, n0 long, n1 long"
    summed = train.mapInPandas(count, shape).groupBy("slice").applyInPandas(add, shape)
    rows = summed.orderBy("slice").collect()  # a fixed number of rows of a fixed size
    if not rows:
        return np.zeros(1 << grams.bits), 0, 0
    n0, n1 = rows[0]["n0"], rows[0]["n1"]
    clean, toxic = np.concatenate(
        [np.frombuffer(r["counts"], np.int64).reshape(2, -1) for r in rows], axis=1
    )
    rate = (clean + toxic) / (n0 + n1)
    floor = 0.5 / (n0 + n1)
    of_toxic = (toxic + smoothing * rate + floor) / (n1 + smoothing)
    of_clean = (clean + smoothing * rate + floor) / (n0 + smoothing)
    return np.log(of_toxic / of_clean), n0, n1


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    grams: Grams = Grams(),
    smoothing: float = 4.0,
    sample_rows: int = 12_000,
    shards: int = 6,
    rounds: int = 3,
    epochs: int = 3,
    rate: float = 0.05,
    decay: float = 1e-6,
    broadcast_rows: int = 4_000_000,
) -> ToxicityModel:
    """Fit the model to the documents that ``labels (doc_id, toxic)`` marks 0 or 1.

    The ratios count all labelled documents. The weights are fitted to at most ``sample_rows`` of them,
    the first by a hash of the id: logistic regression in ``shards`` groups at a time, averaged after each
    of ``rounds``. A document marked more than once counts as toxic if any mark says so; a null mark is
    none. Without documents of both classes the score is constant: 1 with toxic ones only, else 0.
    """
    marked = labels.where(F.col(toxic).isin(0, 1)).groupBy(F.col(doc_id).alias("marked"))
    marked = marked.agg(F.max(toxic).cast("int").alias("toxic"))
    if marked.count() <= broadcast_rows:
        marked = F.broadcast(marked)
    found = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    train = found.join(marked, F.col("doc") == F.col("marked")).select("doc", "text", "toxic")
    ratios, n0, n1 = log_count_ratios(train.select("text", "toxic"), grams, smoothing)
    if not n0 or not n1:
        return ToxicityModel(grams, np.zeros(len(ratios)), 20.0 if n1 else -20.0)

    order = F.xxhash64("doc")
    part = min(1.0, sample_rows / (n0 + n1))
    below = int(-(2**63) + part * 2**64) if part < 1 else None
    sample = train if below is None else train.where(order < below)
    sample = kept(sample.select("text", "toxic", order.alias("at"), F.pmod(order, shards).alias("shard")), "sample")

    weights, bias = np.zeros(len(ratios)), float(np.log(n1 / n0))
    for _ in range(rounds):

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("at", kind="stable")
            seen, w, b = np.zeros(1 << grams.bits, bool), weights.copy(), bias
            marks = [grams.mark(t, seen) for t in rows["text"]]
            for _ in range(epochs):
                for found, y in zip(marks, rows["toxic"]):
                    x = ratios[found]
                    p = 1.0 / (1.0 + np.exp(-np.clip(b + w[found] @ x, -500, 500)))
                    step = rate * (y - p) / max(1.0, np.sqrt(x @ x))
                    w[found] += step * x - rate * decay * w[found]
                    b += step
            return pd.DataFrame({"w": [w.tobytes()], "b": [b], "n": [len(rows)]})

        fitted = sample.groupBy("shard").applyInPandas(fit, "w binary, b double, n long").collect()
        total = sum(r["n"] for r in fitted)
        weights = sum(np.frombuffer(r["w"]) * (r["n"] / total) for r in fitted)
        bias = sum(r["b"] * r["n"] / total for r in fitted)
    return ToxicityModel(grams, weights * ratios, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in column ``out``."""
    return docs.withColumn(out, model.score(F.col(text)))
