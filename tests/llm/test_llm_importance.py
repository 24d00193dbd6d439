"""Importance resampling: CRC of runs, plain weights and ranks, odd tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from gridstats.llm import importance


def plain(docs, items, buckets=10_000, width=2, seed=7, share=25, min_words=20):
    """Per id ``(n_features, weight, score, rank)`` by plain loops over ``docs`` and texts of ``items``."""

    def found(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    raw, target = np.zeros(buckets), np.zeros(buckets)
    for t in docs.values():
        for b in found(t)[1]:
            raw[b] += 1
    for t in items:
        for b in found(t)[1]:
            target[b] += 1
    made, able = {}, []
    for i, t in docs.items():
        words, bs = found(t)
        gains = [
            math.floor(1000 * math.log((target[b] + 1) * (raw.sum() + buckets) / ((raw[b] + 1) * (target.sum() + buckets))))
            for b in bs
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        made[i] = [len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        if words >= min_words:
            able.append(i)
    able.sort(key=lambda i: (-made[i][2], i is None, i))
    for n, i in enumerate(able[: share * len(able) // 100], 1):
        made[i][3] = n
    return {i: tuple(r) for i, r in made.items()}


TEXTS = {
    1: "One two three " * 12,
    2: None,
    3: "",
    4: " \n\t ",
    5: "é" * 200 + " ÀB İ ſ K 中文 " + "x" * 70 + " " + "y" * 64 + " " + "z" * 65 + " word" * 30,
    6: "alpha beta gamma delta " * 9,
    7: "alpha beta gamma delta " * 9,
    8: "a\x00b\nc-d_e 0 9 @ [ ` { ~ " * 5,
    9: "nineteen " * 19,
    10: "long text of words " * 9_000,
    **{i: f"w{i} " + f"word{i % 7} of the text {i % 3} " * (1 + i % 9) for i in range(11, 90)},
}
ITEMS = ["alpha beta gamma", None, "", "one two", "the text"]


def rows(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in TEXTS.items()], "doc_id long, text string, score string, `rank` long")
    return docs.repartition(3), spark.createDataFrame([(t,) for t in ITEMS], "text string")


@pytest.mark.parametrize("width,buckets,share", [(2, 10_000, 0.25), (3, 97, 0.5), (1, 10_000, 1.0)])
def test_against_plain_loops(spark, tables, width, buckets, share):
    docs, items = tables
    got = rows(importance.importance_ranks(docs, items, width=width, buckets=buckets, share=share))
    assert got == plain(TEXTS, ITEMS, buckets, width, share=round(100 * share))


def test_crc_of_runs():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in [1, 2, 3, 63, 64, 65, 200, 5000, 7]]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    crc = importance.Crc32()
    one = crc.of(data, starts, ends)
    assert one.tolist() == [zlib.crc32(w) for w in words]
    both = crc.with_space(one[:-1], one[1:], (ends - starts)[1:])
    assert both.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]


def test_texts_of_a_batch_do_not_meet():
    crc = importance.Crc32()
    apart = [importance.batch_features([t], 2, 10_000, crc).bucket for t in ("a b", "c", None, "d e f")]
    joined = importance.batch_features(["a b", "c", None, "d e f"], 2, 10_000, crc)
    assert sorted(joined.bucket) == sorted(np.concatenate(apart)) and joined.n_words.tolist() == [2, 1, 0, 3]


def test_batches_make_no_difference(spark, tables, monkeypatch):
    docs, items = tables
    whole = rows(importance.importance_ranks(docs, items))
    monkeypatch.setattr(importance, "_BATCH_BYTES", 50)
    assert rows(importance.importance_ranks(docs.repartition(7), items)) == whole


def test_null_ids_ties_and_copies_of_rows(spark):
    text = "some words that are all alike " * 5
    docs = spark.createDataFrame([(None, text)] * 3 + [(2**60 + 1, text)] * 2 + [(5, "short")], "doc_id long, text string")
    got = importance.importance_ranks(docs, docs, share=1.0).orderBy("rank").collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == [1, 2, 3, 4, 5]
    by_score = [(-r.score, r.doc_id is None) for r in got if r["rank"] is not None]
    assert by_score == sorted(by_score) and {r.doc_id for r in got} == {None, 2**60 + 1, 5}


def test_empty_tables(spark, tables):
    docs, items = tables
    assert importance.importance_ranks(docs.limit(0), items).collect() == []
    none = rows(importance.importance_ranks(docs, items.limit(0)))
    assert none == plain(TEXTS, [])


def test_drawn_rows_keep_their_columns(spark, tables):
    docs, items = tables
    drawn = importance.importance_resample(docs, items)
    assert drawn.columns == docs.columns
    expected = {i for i, r in plain(TEXTS, ITEMS).items() if r[3]}
    assert {r.doc_id for r in drawn.collect()} == expected
