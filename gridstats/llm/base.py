"""What several operators need: places of rows, and components of links."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.shared import kept


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _place(df: DataFrame) -> Column:
    row = df.metadataColumn("_metadata")
    return F.struct(row["file_path"].alias("file"), row["row_index"].alias("row"))


def placed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a column that tells where each row lies, ``(file, row)``, and that column's name.

    Rows read from Parquet files lie there already; any other table is first written to the shared folder.
    Two readings of the same files give the same places.
    """
    name = fresh(df, "_place")
    try:
        return df.select("*", _place(df).alias(name)), name
    except AnalysisException:
        written = kept(df, "rows")
        return written.select("*", _place(written).alias(name)), name


def row_order(doc_id: Column, place: Column) -> Column:
    """A struct by which rows sort: by id, rows without one last, rows of one id by their place."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), place.alias("place"))


def without(df: DataFrame, place: str, dropped: DataFrame, at: str) -> DataFrame:
    """Rows of ``df`` whose place is not among ``dropped[at]``; the place column goes."""
    gone = dropped.select(F.col(at).alias("_gone_place"))
    same = df[place] == gone["_gone_place"]
    return df.join(gone, same, "left_anti").drop(place)


def components(links: DataFrame, max_rounds: int = 60, hint: str | None = None) -> DataFrame:
    """Connected components of ``links (a, b)``: ``(node, root)``, root the smallest node of each.

    Large-star and small-star steps in turn: every node's neighbours are tied to the smallest of them, so
    that after a number of rounds that grows with the logarithm of the size each node hangs at its root. The
    last round is told by its links: every node has one, and no root hangs at another node.
    Each step of a round is a written table, so that no step is computed for the minimum and again for the join, and
    plans, which the driver keeps, stay short; no component is ever gathered in one place. Links of a node to itself
    are allowed, nodes without any link are not in the result. ``hint`` is the strategy of the joins, such as
    ``merge`` where tables that Spark would broadcast are more than the driver should hold.
    """

    def hinted(df: DataFrame) -> DataFrame:
        return df.hint(hint) if hint else df

    links = kept(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(hinted(low), "a").where(F.col("b") > F.col("a"))
        large = kept(large.select(F.col("b").alias("a"), F.col("low").alias("b")), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(hinted(low), "a")
        # Both steps' links from one reading of the join: a neighbour to the smallest, and the node itself.
        tied = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        links = kept(tied.where("a != b").distinct(), "links")
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
        ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs")))
        each = ends.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
        if not each.agg(F.count_if(F.expr("ups > 1 or (ups = 1 and downs = 1)"))).first()[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
