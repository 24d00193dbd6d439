"""Mixing of sources whose words lie in few long documents."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstats.llm import mixing


@pytest.mark.parametrize("total", [0.3, 0.55, 0.6, 1.3])
def test_heavy_tail_meets_its_target(spark, total):
    rng = np.random.default_rng(5)
    sizes = [20_000 if i % 200 == 0 else int(rng.integers(10, 60)) for i in range(4000)]
    rows = [(i, "w " * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'a' AS source").repartition(4)
    found = mixing.mix(df, weights=(1,), total=total).collect()
    assert len(found) == len(sizes) and all(0 <= r.copies <= 2 and r["size"] == sizes[r.doc_id] for r in found)
    assert abs(sum(r.taken for r in found) - total * sum(sizes)) <= 10


def test_many_sizes_and_repeated_rows(spark):
    rows = [(i, "w " * i, "a" if i % 2 else None) for i in range(1, 1200)] + [(0, "w w w", "a")] * 2000
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    found = mixing.mix(df, total=1.2, docs_per_bucket=16).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert len(found) == len(rows) and all(abs(taken[s] - target[s]) <= 2 for s in target)


def documents(spark, n=3000):
    """Documents of three sources and two languages, a third of them of one source."""
    src = F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 5 == 0, "b").otherwise("c")
    lang = F.when(F.pmod(F.xxhash64("id"), F.lit(4)) == 0, "fr").otherwise("en")
    size = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)) + 1
    return spark.range(0, n, 1, 5).select(F.col("id").alias("doc_id"), src.alias("source"), lang.alias("lang"), size.alias("size"))


def test_overlapping_constraints_are_met(spark):
    docs = documents(spark)
    total = {r.k: r.n for r in docs.groupBy(F.col("source").alias("k")).agg(F.sum("size").alias("n")).collect()}
    french = docs.where("lang = 'fr'").agg(F.sum("size")).first()[0]
    wanted = {"a": 0.5 * total["a"], "b": 1.7 * total["b"], "c": 1.2 * total["c"], "fr": 1.6 * french}
    shares = {k: (F.col("source") == k).cast("int") for k in "abc"} | {"fr": (F.col("lang") == "fr").cast("int")}
    got = mixing.balance(docs, shares, wanted, F.col("size"))
    rated = docs.withColumn("rate", got.rate(shares))
    for name, share in shares.items():
        met = rated.agg(F.sum(F.col("size") * share * F.col("rate"))).first()[0]
        assert abs(met / wanted[name] - 1) < 1e-8
    # Quadratic near the end: a residual is about the square of the one before.
    assert got.residuals[0] > 0.1 and got.residuals[-1] <= 1e-9 and len(got.residuals) <= 12
    assert got.residuals[-1] <= 100 * got.residuals[-2] ** 2 + 1e-12
    # Rates depend on what the constraints see and on nothing else.
    assert rated.select("source", "lang", F.round("rate", 10)).distinct().count() == 6
    copies = rated.withColumn("n", mixing.balanced_copies(F.col("rate"), F.col("doc_id"), F.col("lang")))
    for name, share in shares.items():
        taken = copies.agg(F.sum(F.col("size") * share * F.col("n"))).first()[0]
        assert abs(taken / wanted[name] - 1) < 0.1
    assert all(r.n in (int(r.rate), int(r.rate) + 1) for r in copies.collect())


def test_source_totals_are_one_case(spark):
    """For sources alone the rate is the target over the size, as the closed form of ``mix`` has it."""
    docs = documents(spark)
    shares = {k: (F.col("source") == k).cast("int") for k in "abc"}
    total = {r.k: r.n for r in docs.groupBy(F.col("source").alias("k")).agg(F.sum("size").alias("n")).collect()}
    wanted = {"a": 0.25 * total["a"], "b": 2.0 * total["b"], "c": float(total["c"])}
    got = mixing.balance(docs, shares, wanted, F.col("size"))
    for k in "abc":
        assert abs(np.exp(got.multipliers[k]) - wanted[k] / total[k]) < 1e-8


def test_balance_edges(spark):
    docs = documents(spark, 50)
    one = {"all": F.lit(1)}
    with pytest.raises(ValueError, match="same names"):
        mixing.balance(docs, one, {"other": 1.0}, F.col("size"))
    with pytest.raises(ValueError, match="positive"):
        mixing.balance(docs, one, {"all": 0.0}, F.col("size"))
    with pytest.raises(ValueError):  # the same twice, with other targets
        mixing.balance(docs, one | {"again": F.lit(1)}, {"all": 10.0, "again": 20.0}, F.col("size"))
    with pytest.raises(ValueError):
        mixing.balance(docs.limit(0), one, {"all": 10.0}, F.col("size"))
    odd = docs.unionByName(docs.limit(3).withColumn("size", F.lit(None).cast("long")))
    shares = {"a": F.when(F.col("source") == "a", 0.5)}
    got = mixing.balance(odd, shares, {"a": 100.0}, F.col("size"))
    met = odd.agg(F.sum(F.coalesce(F.col("size") * shares["a"], F.lit(0)) * got.rate({"a": F.coalesce(shares["a"], F.lit(0))})))
    assert abs(met.first()[0] - 100) < 1e-6
