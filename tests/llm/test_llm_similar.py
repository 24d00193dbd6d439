"""Near duplicates by Jaccard similarity against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridstats.llm import similar


def brute(texts):
    """Of ``{id: text}`` the smallest id of each group tied by five-word shingle sets of Jaccard 0.8 or more."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root, pairs = {i: i for i in sets}, 0

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = sets[a] | sets[b]
            if a < b and (not both or len(sets[a] & sets[b]) / len(both) >= 0.8):
                pairs += sets[a] != sets[b]
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {i for i in ids if top(i) == i}, pairs


def near_copies(seed):
    """Texts of 40 to 400 words, copies with a few words changed, a group whose copies are alike only in chains."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(3000)]
    texts = []
    for _ in range(60):
        own = list(rng.choice(words, rng.integers(40, 400)))
        texts.append(" ".join(own))
        for changes in rng.integers(1, 1 + len(own) // 25, 3):
            copy = list(own)
            for at in rng.choice(len(own), changes, replace=False):
                copy[at] = "changed"
            texts.append(" ".join(copy))
    own = list(rng.choice(words, 200))
    for _ in range(30):
        own[rng.integers(200)] = str(rng.integers(10**9))
        texts.append(" ".join(own))
    return dict(enumerate(texts)) | {1000: None, 1001: " \n", 1002: texts[0].upper(), 1003: "one", 1004: "two"}


def left(df):
    return {r.doc_id for r in df.collect()}


def test_stage_drops_pairs_of_similarity_08(spark):
    texts = near_copies(1)
    expected, pairs = brute(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    assert pairs > 60 and left(corpus_pipeline.near_dedup_stage(spark, df, "")) == expected


@pytest.mark.parametrize("rows,shingles", [(2048, 3000), (7, 1 << 20)])
def test_blocks_of_any_size(spark, rows, shingles):
    texts = near_copies(2)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    assert left(similar.drop_similar(df, block_rows=rows, block_shingles=shingles)) == brute(texts)[0]


def test_similar_links_against_all_pairs():
    texts = near_copies(3)
    ids = [i for i, t in texts.items() if (t or "").split()]
    links = similar.similar_links(np.array(ids), [similar.shingles(texts[i], 5) for i in ids], 0.8)
    root = {i: i for i in ids}
    for a, b in links:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = {i: new if r == old else r for i, r in root.items()}
    assert {i for i in ids if root[i] == i} == brute({i: texts[i] for i in ids})[0]


def test_fingerprints_alone_tie_close_copies(spark, monkeypatch):
    """Without the exact join for what they leave apart, fingerprints in the tree tie texts with a word changed."""
    rng = np.random.default_rng(4)
    words, texts = [f"w{k}" for k in range(3000)], {}
    for i in range(20):
        own = list(rng.choice(words, 300))
        texts[i] = " ".join(own)
        own[rng.integers(300)] = "changed"
        texts[100 + i] = " ".join(own)
    marks = {i: similar.set_fingerprint(similar.shingles(t, 5)) for i, t in texts.items()}
    assert all(((marks[i] ^ marks[100 + i]) & (2**64 - 1)).bit_count() <= 10 for i in range(20))

    def nothing_left(points, prefixes, links):
        return points.select(F.col("fp").alias("root"), "*").limit(0)

    monkeypatch.setattr(similar, "_groups_left", nothing_left)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    assert left(corpus_pipeline.near_dedup_stage(spark, df, "")) == brute(texts)[0] == set(range(20))


def test_near_groups_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    marks = [int(x) for x in rng.integers(-(2**63), 2**63, 150)]
    for at in range(100):
        for bit in rng.choice(64, int(rng.integers(0, 14)), replace=False):
            marks.append(marks[at] ^ (1 << int(bit) if bit < 63 else 0))
    for at in range(40):
        far = int(sum(1 << int(b) for b in rng.choice(63, int(rng.integers(8, 13)), replace=False)))
        marks.append(marks[at] ^ far)
    root = list(range(len(marks)))
    for a, x in enumerate(marks):
        for b, y in enumerate(marks[:a]):
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 10 and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    expected = {tuple(i for i, r in enumerate(root) if r == one) for one in set(root) if root.count(one) > 1}
    points = spark.createDataFrame(list(enumerate(marks)), "key bigint, fp bigint")
    found = {}
    for r in similar.near_groups(points, 10).collect():
        found.setdefault(r.root, []).append(r.key)
    assert {tuple(sorted(g)) for g in found.values()} == expected
