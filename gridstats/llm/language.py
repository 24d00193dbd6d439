"""Language by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter n-gram binds its letters: the product
of their vectors, each rotated by its place. A text is the sum of its n-gram vectors, a language the sum of
its texts, and a text belongs to the language whose vector makes the smallest angle with its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
_WORDS = regex.compile(r"\p{L}+")
_PIECE = 1 << 20
_ROWS, _CHARS = 128, 1 << 20


@dataclass(frozen=True)
class Space:
    """Letter vectors of ``size`` entries, made from ``seed`` and the code point, and n-grams of 3."""

    size: int = 1024
    seed: int = 7

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the lower-cased words of a text, blanks at word ends, and their counts."""
        found = _WORDS.findall((text or "").lower())
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        points = np.frombuffer(f" {' '.join(found)} ".encode("utf-32-le"), np.uint32)
        parts = []
        for i in range(0, len(points) - 2, _PIECE):
            p = points[i : i + _PIECE + 2].astype(np.uint64)
            keys = p[:-2] << np.uint64(42) | p[1:-1] << np.uint64(21) | p[2:]
            parts.append(np.unique(keys, return_counts=True))
        if len(parts) == 1:
            return parts[0]
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of n-grams, one in a row."""
        places = [(keys >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (42, 21, 0)]
        letters, at = np.unique(np.concatenate(places), return_inverse=True)
        own = np.stack(
            [np.random.default_rng([self.seed, int(c)]).integers(0, 2, self.size) for c in letters]
        )
        own = (own * 2 - 1).astype(np.int8)
        bound = np.ones((len(keys), self.size), np.int8)
        for shift, which in zip((2, 1, 0), np.split(at, 3)):
            bound *= np.roll(own, shift, axis=1)[which]
        return bound.astype(np.float32)

    def bundles(self, texts: list[str | None], groups: np.ndarray | None = None) -> np.ndarray:
        """The vectors of texts, or of groups of texts, one in a row."""
        each = [self.grams(t) for t in texts]
        keys, at = np.unique(np.concatenate([k for k, _ in each]), return_inverse=True)
        rows = np.arange(len(texts)) if groups is None else groups
        counts = np.zeros((int(rows.max()) + 1, len(keys)), np.float32)
        owner = np.repeat(rows, [len(k) for k, _ in each])
        np.add.at(counts, (owner, at), np.concatenate([n for _, n in each]))
        if not len(keys):
            return np.zeros((len(counts), self.size), np.float32)
        return counts @ self.vectors(keys)


def _runs(texts: list[str | None]) -> Iterator[slice]:
    """Cuts of at most ``_ROWS`` texts, shorter if they are long."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if i + 1 - start == _ROWS or chars > _CHARS:
            yield slice(start, i + 1)
            start, chars = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


@dataclass(frozen=True)
class LanguageModel:
    space: Space
    languages: list[str]
    prototypes: np.ndarray  # of length 1, one in a row

    def predict(self, text: Column) -> Column:
        """``struct<lang, score>`` of a text; the score is the cosine, 0 if negative.

        A text that is null or has no letter is ``und`` with score 0, and so is every text if no language
        was learned. Ties go to the language that sorts first.
        """
        space, languages, prototypes = self.space, self.languages, self.prototypes

        @F.pandas_udf(T.StructType().add("lang", T.StringType()).add("score", T.DoubleType()))
        def predict(texts: pd.Series) -> pd.DataFrame:
            values = texts.tolist()
            langs, scores = np.full(len(values), UNKNOWN, object), np.zeros(len(values))
            for cut in _runs(values) if languages else ():
                made = space.bundles(values[cut])
                lengths = np.linalg.norm(made, axis=1)
                near = (made @ prototypes.T) / np.maximum(lengths, 1e-30)[:, None]
                best = near.argmax(axis=1)
                known = lengths > 0
                langs[cut] = np.where(known, np.array(languages, object)[best], UNKNOWN)
                scores[cut] = np.where(known, np.clip(near[np.arange(len(best)), best], 0, 1), 0)
            return pd.DataFrame({"lang": langs, "score": scores})

        return predict(text)


def train_languages(
    docs: DataFrame, text: str = "text", lang: str = "lang", space: Space = Space(), most: int = 10_000
) -> LanguageModel:
    """Learn a prototype from all texts of each non-null language.

    Every task sums the texts of a language it reads, so a language that holds most texts sends no more
    than another. The prototypes come to the driver; more than ``most`` languages are an error. Sums are
    of whole numbers and do not depend on their order.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            values, langs = batch["text"].tolist(), batch["lang"].to_numpy(object)
            for cut in _runs(values):
                names, groups = np.unique(langs[cut].astype(str), return_inverse=True)
                for name, row in zip(names.tolist(), space.bundles(values[cut], groups)):
                    sums[name] = sums.get(name, 0.0) + row.astype(np.float64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL")
    parts = rows.mapInPandas(add, "lang string, v array<double>")
    summed = parts.select("lang", F.posexplode("v").alias("at", "v")).groupBy("lang", "at").agg(
        F.sum("v").alias("v")
    )
    vectors = summed.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("v")
    )
    learned = sorted(vectors.limit(most + 1).collect(), key=lambda r: r["lang"])
    if len(learned) > most:
        raise ValueError(f"more than {most} languages")
    learned = [r for r in learned if any(r["v"])]
    sums = np.array([r["v"] for r in learned]).reshape(-1, space.size)
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-30)
    return LanguageModel(space, [r["lang"] for r in learned], unit.astype(np.float32))
