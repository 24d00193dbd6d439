"""Toxicity and language models against plain versions over the smallest tables, and long texts in pieces."""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstats.llm import language, similar, toxicity
from gridstats.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", F.xxhash64("doc_id").alias("at"))
    return {r.doc_id: r for r in rows.collect()}


def features(text, bits=18):
    """Hashed n-grams of 3 to 6 characters, one by one."""
    line = [ord(c) for c in f" {(text or '').lower()} "]
    found = set()
    for n in range(3, 7):
        for i in range(len(line) - n + 1):
            h = line[i] * 0x9E3779B1 % 2**32
            for c in line[i + 1 : i + n]:
                h = (h * 0x01000193 + c * 0x9E3779B1) % 2**32
            found.add(((h ^ h >> 15) * (0x2C1B3C6D + 2 * n) % 2**32) >> (32 - bits))
    return sorted(found)


def test_toxicity_scores_by_plain_loops(spark, docs):
    marks = {}
    for r in spark.read.parquet(f"{DATA}/labels.parquet").collect():
        if r.toxic in (0, 1) and r.doc_id in docs and zlib.crc32(str(r.doc_id).encode()) % 5:
            marks[r.doc_id] = max(r.toxic, marks.get(r.doc_id, 0))
    found = {i: features(d.text) for i, d in docs.items()}
    n = Counter(marks.values())
    counts = [Counter(), Counter()]
    for i, y in marks.items():
        counts[y].update(found[i])
    both = n[0] + n[1]

    def ratio(f):
        rate = (counts[0][f] + counts[1][f]) / both
        toxic = (counts[1][f] + 4.0 * rate + 0.5 / both) / (n[1] + 4.0)
        return math.log(toxic / ((counts[0][f] + 4.0 * rate + 0.5 / both) / (n[0] + 4.0)))

    ratios = {f: ratio(f) for f in set().union(*found.values())}
    # Logistic regression in six shards by hash, averaged three times.
    shards = [[] for _ in range(6)]
    for i in sorted(marks, key=lambda i: docs[i].at):
        shards[docs[i].at % 6].append(i)
    weights, bias = Counter(), math.log(n[1] / n[0])
    for _ in range(3):
        mean, mean_bias = Counter(), 0.0
        for shard in shards:
            w, b = dict(weights), bias
            for _ in range(3):
                for i in shard:
                    x = [ratios[f] for f in found[i]]
                    z = b + sum(w.get(f, 0.0) * v for f, v in zip(found[i], x))
                    p = 1 / (1 + math.exp(-max(-500, min(500, z))))
                    step = 0.05 * (marks[i] - p) / max(1.0, math.sqrt(sum(v * v for v in x)))
                    for f, v in zip(found[i], x):
                        w[f] = w.get(f, 0.0) + step * v - 0.05 * 1e-6 * w.get(f, 0.0)
                    b += step
            for f, v in w.items():
                mean[f] += v * len(shard) / both
            mean_bias += b * len(shard) / both
        weights, bias = mean, mean_bias
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, DATA).collect()}
    for i in docs:
        score = 1 / (1 + math.exp(-(bias + sum(weights[f] * ratios[f] for f in found[i]))))
        assert math.isclose(got[i].score, score, rel_tol=1e-7, abs_tol=1e-12)


def letters_only(text):
    """Runs of letters of a lower-cased text, parted by one blank, blanks at both ends; none without letters."""
    said = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())
    return f" {' '.join(said.split())} " if said.split() else ""


def test_languages_by_plain_vectors(spark, docs):
    letters = {}

    def letter(c):
        if c not in letters:
            letters[c] = np.random.default_rng([7, ord(c)]).integers(0, 2, 1024) * 2 - 1
        return letters[c]

    grams = {}

    def bundle(text):
        line, total = letters_only(text), np.zeros(1024)
        for g, n in Counter(line[i : i + 3] for i in range(len(line) - 2)).items():
            if g not in grams:
                grams[g] = np.roll(letter(g[0]), 2) * np.roll(letter(g[1]), 1) * letter(g[2])
            total += n * grams[g]
        return total

    own = {i: bundle(d.text) for i, d in docs.items()}
    prototypes = {}
    for i, d in docs.items():
        if d.lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            prototypes[d.lang] = prototypes.get(d.lang, 0) + own[i]
    got = {r.doc_id: r for r in QUERIES["op2_language"](spark, DATA).collect()}
    for i in docs:
        near = {
            lang: own[i] @ p / (np.linalg.norm(own[i]) * np.linalg.norm(p)) if own[i].any() else 0.0
            for lang, p in prototypes.items()
        }
        if not own[i].any():
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        best = max(near.values())
        assert near[got[i].lang_pred] >= best - 1e-5
        assert abs(got[i].score - max(0.0, best)) < 1e-5


def test_long_texts_in_pieces(monkeypatch):
    """Texts longer than a piece give what they give whole."""
    text = " ".join(f"wörd{i % 97} and {i * i % 1013}" for i in range(3000))
    seen = np.zeros(1 << 18, bool)
    marks, keys = toxicity.Grams().mark(text, seen), language.Space().grams(text)
    for piece in (7, 100, 4096):
        monkeypatch.setattr(toxicity, "_PIECE", piece)
        monkeypatch.setattr(language, "_PIECE", piece)
        assert toxicity.Grams().mark(text, seen).tolist() == marks.tolist()
        again = language.Space().grams(text)
        assert again[0].tolist() == keys[0].tolist() and again[1].tolist() == keys[1].tolist()
    assert marks.tolist() == features(text)


@pytest.mark.parametrize("chars", [1 << 23, 300])
def test_similar_texts_in_runs_of_any_size(spark, monkeypatch, chars):
    from test_llm_similar import brute, left, near_copies

    monkeypatch.setattr(similar, "_RUN_CHARS", chars)
    texts = near_copies(5)
    short = {2000 + i: " ".join(f"s{k}" for k in range(n)) + extra for i, (n, extra) in enumerate(
        (n, extra) for n in range(5, 36) for extra in ("", " end", " two ends")
    )}
    texts |= short
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    assert left(similar.drop_similar(df, bucket_bytes=2000)) == brute(texts)[0]
