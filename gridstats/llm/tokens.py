"""Token counts by an exact histogram of encoded lengths."""

from __future__ import annotations

import base64
from collections.abc import Sequence
from pathlib import Path

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's tokenizer parts a text before it merges bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLOCK = 1024


def encoded_length(text: Column, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    """Tokens of a text; null has none, and control strings in it count as ordinary text.

    The file of ranks is read here and shipped, so executors need no copy of it.
    """
    ranks_file = Path(vocabulary).read_bytes()

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        encoder = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        return pd.Series([len(encoder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def length_histogram(docs: DataFrame, length: Column) -> DataFrame:
    """``length, n_docs`` over all documents; a null length counts as 0."""
    each = docs.select(F.coalesce(length, F.lit(0)).cast("bigint").alias("length"))
    return each.groupBy("length").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """What every context limit that is a length keeps.

    Adds, for a limit of ``length`` tokens: ``docs_over`` and ``tokens_over`` (documents longer than the
    limit, and all their tokens), ``docs_within``, ``tokens_within``, ``truncated_total`` (tokens left when
    every document is cut at the limit) and ``truncated_away``.

    Lengths are summed in blocks, blocks by one row each, and the sums carried back: only the row per
    block, that is one in ``1024`` possible lengths, meets in one task.
    """
    cut = histogram.withColumn("block", F.floor(F.col("length") / _BLOCK))
    tokens = F.col("n_docs") * F.col("length")
    blocks = cut.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum(tokens).alias("block_tokens")
    )
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        F.col("block").alias("of_block"),
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    joined = cut.join(blocks, F.col("block") == F.col("of_block"))
    longer = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    docs_over = F.col("later_docs") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0))
    tokens_over = F.col("later_tokens") + F.coalesce(F.sum(tokens).over(longer), F.lit(0))
    summed = joined.select(
        "length", "n_docs", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"),
        "all_docs", "all_tokens",
    )
    within = F.col("all_tokens") - F.col("tokens_over")
    kept_of_longer = F.col("docs_over") * F.col("length")
    return summed.select(
        "length",
        "n_docs",
        "docs_over",
        "tokens_over",
        (F.col("all_docs") - F.col("docs_over")).alias("docs_within"),
        within.alias("tokens_within"),
        (within + kept_of_longer).alias("truncated_total"),
        (F.col("tokens_over") - kept_of_longer).alias("truncated_away"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``limit, docs_over, docs_within, truncated_total`` for any limits, from the sums.

    The longest length within a limit answers for it; below the shortest one, every document is over.
    """
    asked = F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits]))
    total = F.sum("n_docs")
    rows = sums.select("*", asked.alias("limit"))
    fits = F.col("length") <= F.col("limit")
    found = rows.groupBy("limit").agg(
        F.max_by(
            F.when(fits, F.struct("docs_over", "docs_within", "tokens_within")),
            F.when(fits, F.col("length")),
        ).alias("last"),
        total.alias("all_docs"),
    )
    over = F.coalesce(F.col("last.docs_over"), F.col("all_docs"))
    return found.select(
        "limit",
        over.alias("docs_over"),
        F.coalesce(F.col("last.docs_within"), F.lit(0)).cast("bigint").alias("docs_within"),
        (F.coalesce(F.col("last.tokens_within"), F.lit(0)) + over * F.col("limit")).alias("truncated_total"),
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, length``: the smallest length within which at least that share of documents lies."""
    asked = F.explode(F.array(*[F.lit(float(q)) for q in shares]))
    rows = sums.select("length", "docs_within", "docs_over", asked.alias("share"))
    enough = F.col("docs_within") >= F.col("share") * (F.col("docs_within") + F.col("docs_over"))
    return rows.groupBy("share").agg(F.min(F.when(enough, F.col("length"))).alias("length"))
