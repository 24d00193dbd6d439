"""A corpus cleaned and mixed in five stages, each written before the next reads it.

Every stage works on all rows its predecessor left and gives back the columns of ``documents``; the last
adds ``copy``, as a document that the mix takes twice is there twice.

Nulls: a null text counts as empty everywhere; a null id is an id that sorts last; null sources are one
source. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm import decontaminate, exact, mixing, similar, toxicity
from gridstats.shared import kept

THRESHOLD = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``THRESHOLD``; learned from labelled ones, less a fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train_toxicity(docs.where(~toxicity.held_out(F.col("doc_id"), 5, 0)), labels)
    return docs.where(model.score(F.col("text")) < THRESHOLD)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of equal texts."""
    return exact.drop_exact_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group tied together by texts that share 0.8 of their shingles; SimHash
    fingerprints within 10 bits are candidates first, what they leave apart is looked for exactly."""
    return similar.drop_similar(docs, width=5, similarity=0.8, radius=10)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix_sources", mix_stage),
]

# Stages 1 and 3 cannot be put in SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = kept(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
