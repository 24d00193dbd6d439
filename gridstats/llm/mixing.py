"""Mixing sources to target weights by entropy balancing, by column expressions alone.

Every source gets a number of words to give. Among all ways to spread them over its documents the one of
greatest entropy over words is sought: rates ``exp(lambda)`` that solve the convex dual
``sum(size * exp(lambda)) - lambda * target``, by Newton steps per source. Rates are then rounded into
whole copies, size by size, with what rounding leaves carried to the next smaller size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.llm.base import fresh, placed
from gridstats.shared import kept


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    # A text of one run or more has one blank run less than words.
    n = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return F.when(trimmed == "", F.lit(0)).otherwise(n).cast("bigint")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[float], total: float, most: float
) -> DataFrame:
    """Per source: ``source, n_docs, source_size, target``.

    Sources by code point, null last, take ``weights`` in turn and share ``total`` times all sizes. A
    target stops at ``most`` times its source's size; what is over goes to the others by weight, until
    none is above: all targets are ``least(cap, weight * level)`` for one level. The windows here run over
    one row per source.
    """
    if min(weights) <= 0 or not 0 <= total <= most:
        raise ValueError("weights must be positive and total between 0 and most")
    per = sizes.groupBy(source).agg(
        F.count("*").alias("n_docs"), F.sum(size).cast("bigint").alias("source_size")
    )
    turn = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn, len(weights)) + 1)
    weighed = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    # By the level at which a source is full. A source is full if the level that the fuller ones leave is
    # above its own.
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col(source).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sought = F.sum("source_size").over(everything) * float(total)
    left = sought - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    weighed = weighed.select("*", sought.alias("sought"), (left / open_weight).alias("level"))
    full = F.col("cap") <= F.col("weight") * F.col("level")
    weighed = weighed.withColumn("full", full)
    full_caps = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    shared = F.least(F.col("cap"), (F.col("sought") - full_caps) * F.col("weight") / rest)
    target = F.when(F.col("full"), F.col("cap")).otherwise(shared)
    return weighed.select(source, "n_docs", "source_size", target.alias("target"))


def newton_rate(mass: Column, target: Column, steps: int = 60) -> Column:
    """``exp(lambda)`` at the minimum of ``mass * exp(lambda) - lambda * target``; 0 without a target.

    Newton steps from lambda = 0, no longer than 1: gradient ``mass * exp(lambda) - target`` over
    curvature ``mass * exp(lambda)``. They converge quadratically once near.
    """

    def step(at: Column, _: Column) -> Column:
        move = target / (mass * F.exp(at)) - 1.0
        return at + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), move))

    best = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step)
    return F.when((mass > 0) & (target > 0), F.exp(best)).otherwise(0.0)


@dataclass(frozen=True)
class Balance:
    """Multipliers of the constraints, and how far their sums were from the targets before each step, the
    largest share of a target."""

    multipliers: dict[str, float]
    residuals: list[float]

    def rate(self, constraints: Mapping[str, Column]) -> Column:
        """Copies a document is worth: ``exp`` of the sum of its constraints' multipliers."""
        return F.exp(sum((c.cast("double") * self.multipliers[n] for n, c in constraints.items()), F.lit(0.0)))


def balance(
    docs: DataFrame,
    constraints: Mapping[str, Column],
    targets: Mapping[str, float],
    size: Column,
    steps: int = 50,
    tolerance: float = 1e-9,
) -> Balance:
    """Entropy balancing under any token constraints: ``sum(size * x * rate) = target`` for each of them.

    ``constraints`` are columns with the share of a document's words that counts towards each target, such as
    1 for the documents of a source and 0 for others; they may overlap. The rates that meet all of them with
    the greatest entropy over words are ``exp(x . lambda)``, and lambda minimises a convex function. Each
    Newton step sums its gradient and its Hessian over all documents in one aggregate; the driver gets these
    ``m + m * m`` numbers, not the documents, and halves a step that does not bring the function down. Null
    shares and sizes count as 0. Targets that no rates can meet end in an error, as do constraints that say
    the same twice. ``docs`` is read once for each step, so keep sizes and shares in a small table first.
    """
    names = list(constraints)
    if set(targets) != set(names):
        raise ValueError("constraints and targets must have the same names")
    if min(targets.values(), default=1) <= 0:
        raise ValueError("targets must be positive")
    wanted = np.array([float(targets[n]) for n in names])
    x = [F.coalesce(constraints[n].cast("double"), F.lit(0.0)).alias(f"x{i}") for i, n in enumerate(names)]
    held = docs.select(F.coalesce(size.cast("double"), F.lit(0.0)).alias("size"), *x)

    def sums(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        tilt = F.exp(sum((F.col(f"x{i}") * float(v) for i, v in enumerate(at)), F.lit(0.0))) * F.col("size")
        m = range(len(names))
        rows = held.withColumn("mass", tilt).agg(
            F.sum("mass").alias("all"),
            *[F.sum(F.col("mass") * F.col(f"x{i}")).alias(f"g{i}") for i in m],
            *[F.sum(F.col("mass") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i in m for j in m if i <= j],
        )
        row = rows.first()
        gradient = np.array([row[f"g{i}"] or 0.0 for i in m])
        hessian = np.array([[row[f"h{min(i, j)}_{max(i, j)}"] or 0.0 for j in m] for i in m]).reshape(len(m), len(m))
        return (row["all"] or 0.0) - float(at @ wanted), gradient - wanted, hessian

    at, residuals = np.zeros(len(names)), []
    value, gradient, hessian = sums(at)
    for _ in range(steps):
        residuals.append(float(np.abs(gradient / wanted).max(initial=0.0)))
        if residuals[-1] <= tolerance:
            return Balance(dict(zip(names, at.tolist())), residuals)
        try:
            move = np.linalg.solve(hessian, -gradient)
        except np.linalg.LinAlgError as error:
            raise ValueError("constraints depend on each other, or no document is in one of them") from error
        share = min(1.0, 4.0 / float(np.abs(move).max()))
        while True:
            new = sums(at + share * move)
            if np.isfinite(new[0]) and new[0] <= value + 1e-4 * share * float(gradient @ move) + 1e-12 * abs(value):
                break
            share /= 2
            if share < 1e-9:
                raise ValueError(f"targets cannot be met: off by {residuals[-1]:.3g} of one")
        at, (value, gradient, hessian) = at + share * move, new
    raise ValueError(f"targets not met after {steps} steps: off by {residuals[-1]:.3g} of one")


def balanced_copies(rate: Column, doc_id: Column, text: Column, seed: int = 0) -> Column:
    """Whole copies for a rate: its floor, and one more for a share of documents that equals the rest,
    chosen by a hash of id and text, so that reruns agree."""
    u = F.pmod(F.xxhash64(F.lit(seed), doc_id, text), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int")


def _shares(sized: DataFrame, most: int, step: int = 256) -> DataFrame:
    """Per source and size: ``of_src, of_size, n_same, source_size, target, rate, share``, the last the copies
    that all documents of the size get together.

    ``sized`` has a row per source and size; those of a source are gone through in one array, largest first,
    ``step`` sizes at a time.
    """
    one = F.struct((-F.col("size")).alias("order"), "size", "n_same")
    fixed = ["src", "source_size", "target", "rate"]
    per = sized.groupBy(*fixed).agg(F.sort_array(F.collect_list(one)).alias("sizes"))
    starts = F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / step).cast("int"))
    runs = F.transform(starts, lambda k: F.slice("sizes", k * step + 1, step))

    def give(state: Column, member: Column) -> Column:
        size, n = member["size"], member["n_same"]
        due = state["due"] + F.col("rate") * size * n
        near = F.least(F.greatest(F.round(due / size), F.lit(0.0)), (n * most).cast("double"))
        share = F.when(size > 0, near).otherwise(0.0)
        return F.struct(
            (due - share * size).alias("due"),
            F.concat(state["given"], F.array(share.cast("bigint"))).alias("given"),
        )

    def through(state: Column, run: Column) -> Column:
        start = F.struct(state["due"].alias("due"), F.array().cast("array<bigint>").alias("given"))
        done = F.aggregate(run, start, give)
        return F.struct(done["due"].alias("due"), F.concat(state["given"], F.array(done["given"])).alias("given"))

    start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<array<bigint>>").alias("given"))
    given = F.flatten(F.aggregate(runs, start, through, lambda s: s["given"])).alias("given")
    each = per.select(*fixed, "sizes", given).select(*fixed, F.explode(F.arrays_zip("sizes", "given")).alias("m"))
    return each.select(
        F.col("src").alias("of_src"), F.col("m.sizes.size").alias("of_size"), F.col("m.sizes.n_same").alias("n_same"),
        "source_size", "target", "rate", F.col("m.given").alias("share"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    total: float = 1.5,
    most: float = 2.0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    docs_per_bucket: int = 256,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, rate, copies, taken`` and the ``carry`` columns.

    ``taken = copies * size``, with at most ``ceil(most)`` copies; reruns agree. Documents of one source and
    size share copies, largest size first: as many as bring the sum the source has taken nearest to the sum
    due; what is left goes on to the next size. In the end no more than half of a smallest document is left,
    as far as the small documents can make up for the large ones. The copies of one size are spread evenly
    over its documents, which are numbered in buckets of about ``docs_per_bucket`` by a hash of id and text,
    so that a source or size that holds most rows is split. A null or blank text has size 0, gets no copy,
    and counts in nothing; null sources form one source; rows repeated in ``docs`` each get copies of their own.
    """
    named = docs.select(
        F.col(doc_id).alias("doc"),
        F.col(source).alias("src"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("mark"),
        F.struct(*[F.col(c) for c in carry]).alias("kept") if carry else F.lit(0).alias("kept"),
    )
    named = kept(named, "sizes")  # the texts are split once
    sized = named.groupBy("src", "size").agg(F.count("*").alias("n_same"))
    words = sized.select("src", "n_same", (F.col("size") * F.col("n_same")).alias("words"))
    targets = source_targets(words, "src", "words", weights, total, most)
    rated = targets.withColumn("rate", newton_rate(F.col("source_size"), F.col("target")))
    rated = rated.withColumnRenamed("src", "rated_src")
    shares = _shares(sized.join(rated, F.col("src").eqNullSafe(F.col("rated_src"))), math.ceil(most))
    same = F.col("src").eqNullSafe(F.col("of_src")) & (F.col("size") == F.col("of_size"))
    joined = named.join(shares, same)
    bucket = F.pmod("mark", F.ceil(F.col("n_same") / docs_per_bucket)).alias("bucket")
    dealt = joined.select("*", bucket)
    held = dealt.groupBy("of_src", "of_size", "bucket").agg(F.count("*").alias("held"))
    before = Window.partitionBy("of_src", "of_size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        F.col("of_src").alias("at_src"),
        F.col("of_size").alias("at_size"),
        F.col("bucket").alias("at_bucket"),
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"),
    )
    # The number of a row in its size; a row gets what the number adds to the copies given so far.
    within = Window.partitionBy("src", "size", "bucket").orderBy("mark", "doc")
    numbered = dealt.withColumn("number", F.row_number().over(within))
    here = (
        F.col("src").eqNullSafe(F.col("at_src"))
        & (F.col("size") == F.col("at_size"))
        & (F.col("bucket") == F.col("at_bucket"))
    )
    placed_at = numbered.join(held, here).withColumn("number", F.col("number") + F.col("ahead"))
    n = F.expr("share div n_same + number * (share % n_same) div n_same - (number - 1) * (share % n_same) div n_same")
    each = placed_at.withColumn("given", n.cast("int"))
    return each.select(
        F.col("doc").alias(doc_id),
        "size",
        "source_size",
        "target",
        "rate",
        F.col("given").alias("copies"),
        (F.col("given") * F.col("size")).cast("bigint").alias("taken"),
        *[F.col(f"kept.`{c}`").alias(c) for c in carry],
    )


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    copy: str = "copy",
    **options,
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies, numbered from 1 in ``copy``.

    All columns stay; rows without a copy go. ``options`` are those of ``mix``. Only sizes and places are
    dealt into buckets, the texts join the result afterwards.
    """
    at, place = placed(docs)
    taken = mix(at, doc_id=doc_id, text=text, source=source, carry=(place,), **options)
    taken = taken.where("copies > 0").select(
        F.col(place).alias("_taken_place"), F.col("copies").alias("_taken_copies")
    )
    joined = at.join(taken, at[place] == taken["_taken_place"])
    name = fresh(docs, copy)
    each = F.explode(F.sequence(F.lit(1), taken["_taken_copies"])).alias(name)
    return joined.select(*[at[c] for c in docs.columns], each)
