"""Registered entries against SQL or brute force over whole tables at the smallest scale."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from compare import difference
from gridstats.llm import katz, tokens
from gridstats.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    return {r.doc_id: r for r in rows}


def by_id(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, DATA).collect()}


@pytest.mark.parametrize("name", SQL)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert difference(QUERIES[name](spark, DATA), con, SQL[name]) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_toxicity_on_held_out_rows(spark, docs):
    found = by_id(spark, "op1_toxicity")
    assert set(found) == set(docs)
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_language_on_held_out_rows(spark, docs):
    found = by_id(spark, "op2_language")
    held = [i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i in docs if found[i].held_out] == held
    assert np.mean([found[i].lang_pred == docs[i].lang for i in held]) >= 0.95


def test_katz_scores(spark, docs):
    found = by_id(spark, "op4_katz_scores")
    one, two = Counter(), defaultdict(Counter)
    end, start = 1, 0
    words = {i: [*(r.text or "").encode().lower().split(), end] for i, r in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    for i, ws in words.items():
        if not held[i]:
            one.update(ws)
            for u, w in zip([start, *ws], ws):
                two[u][w] += 1
    n, v = sum(one.values()), len(one)

    def given(counts):
        of = Counter(counts)
        d = katz.discounts([of[r] for r in range(1, 7)])
        return lambda c: d[c - 1] * c if c <= 5 else c - 1e-3

    of_one, of_two = given(one.values()), given([c for f in two.values() for c in f.values()])
    unknown = 1 - sum(of_one(c) for c in one.values()) / n
    p1 = {w: of_one(c) / n for w, c in one.items()}
    weight = {
        u: (1 - sum(of_two(c) for c in f.values()) / sum(f.values())) / (1 - sum(p1[w] for w in f))
        for u, f in two.items()
    }

    def p(u, w):
        if u not in two:
            return p1.get(w, unknown)
        if w in two[u]:
            return of_two(two[u][w]) / sum(two[u].values())
        return weight[u] * p1.get(w, unknown)

    for u in [start, *list(two)[:20]]:  # distributions sum to one
        assert abs(sum(p(u, w) for w in one) + p(u, "never") - 1) < 1e-9
    for i, ws in words.items():
        r = found[i]
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in ws)
        score = sum(math.log10(p(u, w)) for u, w in zip([start, *ws], ws))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(one[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    # Better than the base on texts it has not seen.
    assert sum(found[i].score for i in docs if held[i]) > sum(found[i].base_score for i in docs if held[i])


def test_token_counts(spark, docs):
    import base64
    from pathlib import Path

    import tiktoken

    lines = map(bytes.split, Path(tokens.VOCABULARY).read_bytes().splitlines())
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    encoder = tiktoken.Encoding("x", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    lengths = [len(encoder.encode_ordinary(r.text or "")) for r in docs.values()]
    sums = QUERIES["op6_token_counts"](spark, DATA)
    rows = {r.length: r for r in sums.collect()}
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        assert r.n_docs == lengths.count(limit)
        assert r.docs_over == sum(x > limit for x in lengths)
        assert r.tokens_over == sum(x for x in lengths if x > limit)
        assert r.docs_within == len(lengths) - r.docs_over
        assert r.tokens_within == sum(lengths) - r.tokens_over
        assert r.truncated_total == sum(min(x, limit) for x in lengths)
        assert r.truncated_away == sum(lengths) - r.truncated_total
    limits = [0, 1, 100, 777, 10**6]
    for r in tokens.at_limits(sums, limits).collect():
        assert (r.docs_over, r.docs_within, r.truncated_total) == (
            sum(x > r.limit for x in lengths),
            sum(x <= r.limit for x in lengths),
            sum(min(x, r.limit) for x in lengths),
        )
    for r in tokens.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r.length == min(x for x in lengths if sum(y <= x for y in lengths) >= r.share * len(lengths))


def test_mix(spark, docs):
    found = by_id(spark, "op8_mix_sources")
    size = {i: len((r.text or "").encode().split()) for i, r in docs.items()}
    total = Counter()
    for i, r in docs.items():
        total[r.source] += size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(total.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * total[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= full
    target |= {s: weight[s] * level for s in free}
    taken = Counter()
    for i, r in docs.items():
        m = found[i]
        assert (m.size, m.source_size) == (size[i], total[r.source])
        assert math.isclose(m.target, target[r.source], rel_tol=1e-9)
        assert 0 <= m.taken <= 2 * size[i] and m.taken % max(1, size[i]) == 0
        taken[r.source] += m.taken
    for s in order:
        smallest = sorted(size[i] for i, r in docs.items() if r.source == s)
        assert abs(taken[s] - target[s]) <= max(smallest[:3])
    again = {r.doc_id: r.taken for r in QUERIES["op8_mix_sources"](spark, DATA).collect()}
    assert again == {i: r.taken for i, r in found.items()}


def test_repeats(spark, docs):
    found = by_id(spark, "op9_repeats")
    data = {i: (r.text or "").encode() for i, r in docs.items()}
    seen = Counter(b[p : p + 400] for b in data.values() for p in range(len(b) - 399))
    some = 0
    for i, b in data.items():
        runs = []
        for p in range(len(b) - 399):
            if seen[b[p : p + 400]] > 1:
                if runs and p <= runs[-1][1]:
                    runs[-1][1] = p + 400
                else:
                    runs.append([p, p + 400])
        kept, last = [], 0
        for s, e in runs:
            kept.append(b[last:s])
            last = e
        kept.append(b[last:])
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(e - s for s, e in runs), len(runs))
        assert r.kept_sha256 == hashlib.sha256(b"".join(kept)).hexdigest()
        some += len(runs) > 0
    assert some > 10


def test_near_duplicates(spark, docs):
    found = by_id(spark, "op10_simhash_dedup")
    prints = {}
    for i, r in docs.items():
        ws = (r.text or "").encode().lower().split()
        hs = [xxhash.xxh64_intdigest(b" ".join(ws[k : k + 4]), 42) for k in range(max(1, len(ws) - 3))] if ws else []
        prints[i] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))
        assert found[i].fingerprint == f"{prints[i]:016x}"
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4 and top(a) != top(b):
                root[max(top(a), top(b))] = min(top(a), top(b))
    assert {i: r.component_id for i, r in found.items()} == {i: top(i) for i in ids}
