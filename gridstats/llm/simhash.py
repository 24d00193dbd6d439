"""Near duplicates by SimHash fingerprints in a vantage-point tree.

Distinct fingerprints are dealt to the leaves of a tree by their Hamming distance to vantage points. A pair
within the radius that the tree parts lies close to a boundary: by the triangle bound one of the two also
visits the other's leaf. Leaves are compared in blocks of bounded size, so all pairs are found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.llm.base import components, placed, row_order, without
from gridstats.shared import kept

SEED = 42
_STEP = 65536


def bits_held(hashes: np.ndarray) -> np.ndarray:
    """In how many 64-bit hashes each bit is set, the highest bit first."""
    rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)


def majority(held: np.ndarray, n: int) -> int:
    """The bits that over half of ``n`` hashes hold."""
    return int(np.packbits(held * 2 > n).view(">u8")[0])


def fingerprint(text: str | None, width: int = 4) -> int:
    """Bits set in over half the XXH64 hashes of the word shingles; 0 without words.

    A-Z is lower-cased, words are parted by blanks, a text of fewer words is one shingle.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends, at = [], -1
    for word in found:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    take = xxhash.xxh64_intdigest
    set_bits, n = np.zeros(64, np.int64), max(1, len(found) - width + 1)
    last = ends[width - 1 :] or ends[-1:]
    for i in range(0, n, _STEP):
        hashes = [take(line[s:e], SEED) for s, e in zip(starts[i : i + _STEP], last[i : i + _STEP])]
        set_bits += bits_held(np.array(hashes, np.uint64))
    return majority(set_bits, n)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")


SHELLS = 6


@dataclass(frozen=True)
class Tree:
    """A full tree whose nodes part points into ``SHELLS`` shells around a vantage point.

    Shells are as wide as the radius, but for the first and the last: a pair within the radius is in one
    shell or in two next to each other. Levels hold an array over their nodes, children in a row.
    """

    vantage: list[np.ndarray]
    low: list[np.ndarray]  # where the first shell would begin
    width: int

    def visits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``leaf, which, home``: in which leaves each point must be compared, and which is its own.

        Of two points that a node parts, the one in the lower shell visits the other's. A visitor goes on
        to all shells within the radius of it.
        """
        which = np.arange(len(points))
        node, home = np.zeros(len(points), np.int64), np.ones(len(points), bool)
        for vantage, low in zip(self.vantage, self.low):
            far = np.bitwise_count(points[which] ^ vantage[node]).astype(np.int64)
            shell = np.clip((far - low[node]) // self.width, 0, SHELLS - 1)
            up, down = shell < SHELLS - 1, (shell > 0) & ~home
            node = node * SHELLS
            home = np.r_[home, np.zeros(up.sum() + down.sum(), bool)]
            which = np.r_[which, which[up], which[down]]
            node = np.r_[node + shell, node[up] + shell[up] + 1, node[down] + shell[down] - 1]
        return node, which, home


def build_tree(sample: np.ndarray, depth: int, radius: int) -> Tree:
    """A tree of ``depth`` levels; the vantage point of a node is one of the sample that reaches it, or
    any if none does. The middle shells meet at the median distance."""
    sample = np.sort(sample) if len(sample) else np.zeros(1, np.uint64)
    width, node = max(1, radius), np.zeros(len(sample), np.int64)
    vantages, lows = [], []
    for level in range(depth):
        vantage = sample[(np.arange(SHELLS**level) * 7919) % len(sample)]
        middle = np.full(SHELLS**level, 32, np.int64)
        order = np.argsort(node, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0, True])
        for start, end in zip(edges[:-1], edges[1:]):
            own, at = sample[order[start:end]], node[order[start]]
            vantage[at] = own[len(own) // 2]
            middle[at] = int(np.median(np.bitwise_count(own ^ vantage[at])))
        low = middle - width * SHELLS // 2
        vantages.append(vantage)
        lows.append(low)
        far = np.bitwise_count(sample ^ vantage[node]).astype(np.int64)
        node = node * SHELLS + np.clip((far - low[node]) // width, 0, SHELLS - 1)
    return Tree(vantages, lows, width)


def _forest(pairs: np.ndarray) -> pd.DataFrame:
    """Of what links ``(a, b)`` tie together, links of the smallest to each other."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    for a, b in pairs.tolist():
        ra, rb = top(a), top(b)
        if ra != rb:
            above[max(ra, rb)] = min(ra, rb)
    used = [(top(x), x) for x in above]
    return pd.DataFrame(np.array(used, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])


def _compare(members: pd.DataFrame, visitors: pd.DataFrame, radius: int) -> pd.DataFrame:
    own = members["fp"].to_numpy(np.int64).view(np.uint64)
    come = visitors["fp"].to_numpy(np.int64).view(np.uint64)
    found, step = [], max(1, (1 << 17) // max(1, len(own)))
    for i in range(0, len(come), step):
        part = come[i : i + step]
        near = np.bitwise_count(part[:, None] ^ own[None, :]) <= radius
        v, m = np.nonzero(near)
        differ = part[v] != own[m]
        if differ.any():
            found.append(np.stack([part[v[differ]], own[m[differ]]], axis=1).view(np.int64))
    return _forest(np.concatenate(found) if found else np.empty((0, 2), np.int64))


def near_links(
    points: DataFrame,
    radius: int = 4,
    leaf_rows: int = 65536,
    block_rows: int = 32768,
    visitor_rows: int = 32768,
    sample_rows: int = 16384,
    mark: str = "fp",
    carried: Sequence[str] = (),
    compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame] | None = None,
) -> DataFrame:
    """Links ``(a, b)`` that tie together what chains of pairs within ``radius`` of the distinct ``fp`` of
    ``points`` tie together.

    The tree takes its vantage points from at most ``sample_rows`` fingerprints, the first by hash; every
    fingerprint is then dealt to it. It is two levels deep, and a level deeper for each third that leaves
    must shrink to hold ``leaf_rows``. Blocks hold about ``block_rows`` members of a leaf and
    ``visitor_rows`` of those that visit it, however many there are of either. A block gives a spanning
    forest of its pairs. Another ``compare`` gets the members and the visitors of a block with the long
    columns ``carried`` and gives the links; ``mark`` is the column by which rows are dealt to blocks.

    Random fingerprints lie at distances close to 32 from any vantage point, so that a level spares only a
    third of the comparisons and triples the visits. Both grow faster than the points: with N distinct
    fingerprints about as N to the power 1.7.
    """
    n = points.count()
    first = points.orderBy(F.xxhash64("fp")).limit(sample_rows).collect()
    sample = np.array([r["fp"] for r in first], dtype=np.int64).view(np.uint64)
    depth = max(2, math.ceil(math.log(max(1, n / leaf_rows), 3)))
    tree = build_tree(sample, depth, radius)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            leaf, which, home = tree.visits(fp.view(np.uint64))
            more = {c: batch[c].to_numpy(np.int64)[which] for c in carried}
            yield pd.DataFrame({"leaf": leaf, "fp": fp[which], "home": home, **more})

    shape = "leaf long, fp long, home boolean" + "".join(f", {c} long" for c in carried)
    visits = kept(points.select("fp", *carried).mapInPandas(deal, shape), "visits")
    held = visits.groupBy("leaf").agg(
        F.ceil(F.count_if("home") / block_rows).alias("parts"),
        F.ceil(F.count("*") / visitor_rows).alias("shifts"),
    )
    visits = visits.join(held.where("parts > 0"), "leaf")
    one_of = lambda c: F.pmod(F.xxhash64(mark), F.col(c))
    each_of = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    members = visits.where("home").select(
        "leaf", "fp", *carried, one_of("parts").alias("part"), each_of("shifts").alias("shift")
    )
    visitors = visits.select(
        "leaf", "fp", *carried, one_of("shifts").alias("shift"), each_of("parts").alias("part")
    )
    visitors = visitors.toDF("to_leaf", "fp", *carried, "to_shift", "to_part")
    of_members = members.groupBy("leaf", "part", "shift")
    of_visitors = visitors.groupBy("to_leaf", "to_part", "to_shift")

    def near(own: pd.DataFrame, come: pd.DataFrame) -> pd.DataFrame:
        return _compare(own, come, radius)

    return of_members.cogroup(of_visitors).applyInPandas(compare or near, "a long, b long")


def _components(docs: DataFrame, place: str, doc_id: str, text: str, radius: int) -> DataFrame:
    """Per row ``row, fp, first``: the first row reachable through near fingerprints."""
    row = row_order(F.col(doc_id), F.col(place)).alias("row")
    rows = kept(docs.select(row, _fingerprints(F.col(text)).alias("fp")), "fingerprints")
    firsts = kept(rows.groupBy("fp").agg(F.min("row").alias("first")), "distinct")
    roots = components(near_links(firsts, radius))
    rooted = firsts.join(roots, firsts["fp"] == roots["node"], "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    return rows.join(rooted.join(lowest, "root").select("fp", "lowest"), "fp")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 4
) -> DataFrame:
    """Per row: ``doc_id, fingerprint, component_id``.

    Rows link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id reachable. Texts
    without words, null ones too, have fingerprint zero and link like any other. Rows without an id come
    after all others; a component of such rows only has a null ``component_id``.
    """
    at, place = placed(docs)
    rows = _components(at, place, doc_id, text, radius)
    return rows.select(
        F.col("row.id").alias(doc_id),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("lowest.id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 4
) -> DataFrame:
    """``docs`` with the first row of each component, all columns as they are."""
    at, place = placed(docs)
    rows = _components(at, place, doc_id, text, radius)
    dropped = rows.where(F.col("row") != F.col("lowest")).select(F.col("row.place").alias("gone"))
    return without(at, place, dropped, "gone")
