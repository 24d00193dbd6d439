"""Near duplicates by SimHash fingerprints of word shingles, checked by their Jaccard similarity, and exactly.

Fingerprints within a radius are found in the vantage-point tree of ``simhash``; what they tie together is
read again, and the shingle sets themselves are compared. Fingerprints of similar sets may lie further
apart, so a set-similarity join by prefixes looks for the links still missing: shingles have one order for
all texts, rare ones first, and two sets of the asked similarity share a shingle among the first few of
both. How many texts hold each shingle is counted in buckets of hashes; a text whose first shingles are its
own alone has no partner and is not sought in the tree. First shingles common to texts that the tree has
not tied together make further candidates, compared in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstats.llm.base import components, placed, row_order, without
from gridstats.llm.repeats import Rolling, _cuts
from gridstats.llm.runs import by_bucket, kept_runs, packed, runs, unpacked
from gridstats.llm.simhash import bits_held, majority, near_links
from gridstats.shared import kept

_U = np.uint64
_SEED = 42
_RUN_CHARS = 8 << 20
_MANY = 255  # texts from which on shingles count as equally frequent
_STEP = 65536


def shingles(text: str | None, width: int, roll: Rolling | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; none without words.

    A-Z is lower-cased, words are parted by blanks, a text of fewer words is one shingle.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, _U)
    roll = roll or Rolling(5)
    line = np.frombuffer(b" ".join(found), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(found) > width:
        starts, ends = starts[: len(found) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    return np.unique(roll.of(roll.prefixes(line), starts, ends))


def _key(hashes: np.ndarray) -> int:
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), _SEED)], _U).view(np.int64)[0])


def set_fingerprint(hashes: np.ndarray) -> int:
    """The SimHash fingerprint of a set of shingles, as a signed number."""
    held = sum((bits_held(hashes[i : i + _STEP]) for i in range(0, len(hashes), _STEP)), np.zeros(64, np.int64))
    return int(np.array([majority(held, len(hashes))], _U).view(np.int64)[0])


def prefix_length(n: int, similarity: float) -> int:
    """How many of the first of ``n`` shingles a similar set must share one of."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def _run_sets(texts: list[str | None], keys: np.ndarray, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys of a run, in order, and the shingle sets of one text of each."""
    own, first = np.unique(keys, return_index=True)
    roll = Rolling(5)
    return own, [shingles(texts[i], width, roll) for i in first]


def _in_buckets(sets: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a run by bucket, in how many of its sets each is, and the buckets."""
    found, n = np.unique(np.concatenate([np.empty(0, _U), *sets]), return_counts=True)
    bucket = (found % _U(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    return found[by], n[by], bucket[by]


def _common_prefixes(run_table: DataFrame, width: int, similarity: float, buckets: int) -> DataFrame:
    """``shingle, key``: shingles in the prefix of a set that other sets hold too.

    A set is taken once for each run. Counts go by 32 bits of the hash beside the bucket: two shingles taken
    for one only seem more frequent than they are, which changes the order for all texts alike.
    """

    def ask(own: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples(index=False))
        _, sets = _run_sets(row.texts, np.frombuffer(row.keys, np.int64), width)
        found, n, bucket = _in_buckets(sets, buckets)
        made = [
            (int(bucket[s]), row.run, (found[s:e] >> _U(32)).astype("<u4").tobytes(), packed(n[s:e]))
            for s, e in zip(*_cuts(bucket))
        ]
        return pd.DataFrame(made, columns=["bucket", "run", "shingles", "n"])

    def count(parts: pd.DataFrame) -> pd.DataFrame:
        found = [np.frombuffer(x, "<u4") for x in parts["shingles"]]
        _, at = np.unique(np.concatenate(found), return_inverse=True)
        total = np.bincount(at, np.concatenate([unpacked(n) for n in parts["n"]]))
        ends = np.cumsum([len(x) for x in found])
        held = np.minimum(total[at], _MANY).astype(np.uint8)
        answers = [held[e - len(x) : e].tobytes() for x, e in zip(found, ends)]
        return pd.DataFrame({"of_run": parts["run"], "bucket": parts["bucket"], "held": answers})

    # By run, though each has one row: a batch of rows could hold many runs.
    parts = run_table.groupBy("run").applyInPandas(ask, "bucket long, run long, shingles binary, n binary")
    answers = by_bucket(parts, buckets).applyInPandas(count, "of_run long, bucket long, held binary")

    def choose(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples(index=False))
        keys, sets = _run_sets(row.texts, np.frombuffer(row.keys, np.int64), width)
        found, _, _ = _in_buckets(sets, buckets)
        rows = rows.sort_values("bucket")
        held = np.concatenate([np.empty(0, np.uint8), *[np.frombuffer(h, np.uint8) for h in rows["held"]]])
        by = np.argsort(found, kind="stable")
        found, held = found[by], held[by]
        made, owner = [np.empty(0, _U)], [np.empty(0, np.int64)]
        for key, one in zip(keys, sets):
            n = held[np.searchsorted(found, one)]
            first = np.lexsort((one, n))[: prefix_length(len(one), similarity)]
            first = first[n[first] > 1]
            made.append(one[first])
            owner.append(np.full(len(first), key))
        return pd.DataFrame({"shingle": np.concatenate(made).view(np.int64), "key": np.concatenate(owner)})

    both = run_table.groupBy("run").cogroup(answers.groupBy("of_run"))
    return both.applyInPandas(choose, "shingle long, key long")


def similar_links(keys: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that tie together what pairs of ``sets`` of the similarity or more tie together.

    From a set on to all sets not reached yet that are similar to it, until all are reached; each is linked to
    the set that began. By ascending keys these links are stars already, which saves rounds of ``components``.
    """
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), size)[np.argsort(term, kind="stable")]
    of_term = np.bincount(term)
    first = np.cumsum(of_term) - of_term
    left = np.ones(len(sets), bool)
    links = []
    for seed in range(len(sets)):
        stack = [seed] if left[seed] else []
        left[seed] = False
        while stack and left.any():
            at = stack.pop()
            t = term[ends[at] - size[at] : ends[at]]
            many = of_term[t]
            place = np.repeat(first[t] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(holder[place], minlength=len(sets))
            whole = np.maximum(size + size[at] - common, 1)
            new = np.flatnonzero(left & (common / whole >= similarity))
            left[new] = False
            links += [(keys[seed], keys[x]) for x in new]
            stack += new.tolist()
    return links


def near_groups(points: DataFrame, radius: int) -> DataFrame:
    """``root`` and the columns of ``points`` (``key, fp, ..``) that chains of fingerprints within ``radius`` tie to
    others."""
    marks = kept(points.select("fp").distinct(), "fingerprints")
    roots = components(near_links(marks, radius), hint="merge")
    rooted = points.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left")
    rooted = rooted.select(F.coalesce("root", "fp").alias("root"), *points.columns)
    several = rooted.groupBy(F.col("root").alias("of")).agg(F.count("*").alias("texts")).where("texts > 1")
    return rooted.join(several.hint("merge"), F.col("root") == F.col("of")).drop("of", "texts")


def _groups_left(points: DataFrame, prefixes: DataFrame, links: DataFrame) -> DataFrame:
    """``root`` and the columns of ``points`` that common first shingles tie together, where ``links`` do not yet."""
    labels = links.groupBy(F.col("b").alias("member")).agg(F.min("a").alias("label"))
    held = prefixes.join(labels.hint("merge"), F.col("key") == F.col("member"), "left")
    held = held.select("shingle", "key", F.coalesce("label", "key").alias("label"))
    lows = held.groupBy(F.col("shingle").alias("of")).agg(
        F.min("key").alias("low"), (F.min("label") < F.max("label")).alias("apart")
    )
    # Merge joins: what Spark would broadcast here comes from all texts, and would pass through the driver.
    of_low = prefixes.join(lows.where("apart").hint("merge"), F.col("shingle") == F.col("of"))
    ties = components(of_low.select(F.col("key").alias("a"), F.col("low").alias("b")), hint="merge")
    ties = ties.unionByName(ties.select(F.col("root").alias("node"), "root").distinct())
    return points.join(ties.hint("merge"), F.col("key") == F.col("node")).drop("node")


def _checked_links(
    at: DataFrame, place: str, text: str, groups: DataFrame, width: int, similarity: float, block_shingles: int,
    block_rows: int,
) -> DataFrame:
    """Links ``(a, b)`` between similar texts, which tie together what similar pairs within ``groups`` tie together."""
    tied = kept(groups.select("root", "key", "n", F.col("first.place").alias("_at")), "tied")
    held = tied.groupBy("root").agg(
        F.greatest(F.ceil(F.sum("n") / block_shingles), F.ceil(F.count("*") / block_rows)).alias("parts")
    )
    total = tied.agg(F.sum("n")).first()[0] or 0
    # Small groups go together; of larger ones each part meets each.
    bundles = max(1, -(-total // block_shingles))
    members = tied.join(held.withColumnRenamed("root", "of"), F.col("root") == F.col("of"))
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    hashed = F.xxhash64("root")
    members = members.select(
        "root",
        "key",
        "_at",
        F.when(F.col("parts") > 1, hashed).otherwise(F.pmod(hashed, F.lit(bundles))).alias("unit"),
        part.alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("meets"),
    )

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            roll = Rolling(5)
            sets = [shingles(t, width, roll).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"of_key": batch["of_key"], "set": sets})

    wanted = tied.select(F.col("key").alias("of_key"), "_at")
    texts = at.select(F.col(text).alias("text"), F.col(place).alias("_from"))
    texts = texts.join(wanted, F.col("_from") == F.col("_at")).select("of_key", "text")
    sets = texts.mapInPandas(hashes, "of_key long, set binary")
    joined = members.join(sets, F.col("key") == F.col("of_key")).select(
        "unit", F.least("part", "meets").alias("low"), F.greatest("part", "meets").alias("high"), "root", "key", "set"
    )

    def similar(block: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, group in block.sort_values("key").groupby("root"):
            found = [np.frombuffer(s, _U) for s in group["set"]]
            links += similar_links(group["key"].to_numpy(np.int64), found, similarity)
        return pd.DataFrame(np.array(links, np.int64).reshape(-1, 2), columns=["a", "b"])

    return joined.groupBy("unit", "low", "high").applyInPandas(similar, "a long, b long")


def drop_similar(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    similarity: float = 0.8,
    block_shingles: int = 1 << 20,
    block_rows: int = 2048,
    bucket_bytes: int = 24 << 20,
    radius: int = 10,
) -> DataFrame:
    """``docs`` with the first row of each group tied together by pairs of texts whose sets of ``width``-word
    shingles have a Jaccard similarity of ``similarity`` or more, all columns as they are.

    Fingerprints that differ in ``radius`` bits or fewer are candidates first, then common first shingles
    where these leave texts apart: no pair is missed, whatever the lengths or the radius. Fingerprints of
    equally large sets of a similarity of 0.8 differ in 9.6 bits on average, random ones rarely in 10 or fewer.
    Texts with equal sets are together, so are texts without words, null ones among them; of rows with one
    id the one that lies first counts as first, null ids come last; an empty table stays empty. A task holds
    the shingles of 8 MB of texts or of a single longer one, or a bucket of about ``bucket_bytes`` of text,
    or a block of ``block_rows`` candidates.
    """
    at, place = placed(docs)
    order = row_order(F.col(doc_id), F.col(place)).alias("row")
    source = at.select(order, F.col(text).alias("text"))
    volume = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll = Rolling(5)
        for number, rows in runs(batches, "text", _RUN_CHARS):
            texts = [t or "" for t in rows["text"]]
            keys, marks, sizes = [], [], []
            for t in texts:
                own = shingles(t, width, roll)
                keys.append(_key(own))
                marks.append(set_fingerprint(own))
                sizes.append(len(own))
            row = (number, list(rows["row"]), np.array(keys, np.int64).tobytes(), keys, marks, sizes, texts)
            yield pd.DataFrame([row], columns=["run", "rows", "keys", "key", "fp", "n", "texts"])

    row_type = source.schema["row"].dataType.simpleString()
    shape = f"run long, rows array<{row_type}>, keys binary, key array<long>, fp array<long>, n array<long>"
    made = source.mapInPandas(gather, f"{shape}, texts array<string>")
    run_table = kept_runs(made, max(8, -(-volume // _RUN_CHARS)), "texts")
    each = run_table.select(F.explode(F.arrays_zip("rows", "key", "fp", "n")).alias("e"))
    rows = each.select(F.col("e.rows").alias("row"), "e.key", "e.fp", "e.n")
    firsts = rows.groupBy("key").agg(F.min("row").alias("first"), F.min("fp").alias("fp"), F.min("n").alias("n"))
    firsts = kept(firsts, "distinct")
    prefixes = _common_prefixes(run_table, width, similarity, max(8, -(-volume // bucket_bytes)))
    prefixes = kept(prefixes.distinct(), "prefixes")
    partners = prefixes.select(F.col("key").alias("of_key")).distinct().hint("merge")
    points = kept(firsts.join(partners, F.col("key") == F.col("of_key"), "left_semi"), "points")

    def checked(groups: DataFrame) -> DataFrame:
        links = _checked_links(at, place, text, groups, width, similarity, block_shingles, block_rows)
        return kept(links, "links")

    near = checked(near_groups(points, radius))
    links = near.unionByName(checked(_groups_left(points, prefixes, near)))
    roots = components(links, hint="merge")
    rooted = firsts.join(roots, F.col("key") == F.col("node"), "left")
    rooted = rooted.select("key", "first", F.coalesce("root", "key").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    first_of = rooted.join(lowest, "root").select(F.col("key").alias("of_key"), "lowest")
    dropped = rows.join(first_of, F.col("key") == F.col("of_key")).where(F.col("row") != F.col("lowest"))
    return without(at, place, dropped.select(F.col("row.place").alias("gone")), "gone")
