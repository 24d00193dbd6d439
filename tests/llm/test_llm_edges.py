"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_similar import brute
from gridstats.shared import kept
from gridstats.llm import (
    base,
    chat,
    decontaminate,
    exact,
    katz,
    language,
    mixing,
    repeats,
    simhash,
    tokens,
    toxicity,
)

LONG = " ".join(f"word{i % 977}" for i in range(6_000))
TEXTS = [
    (1, "The cat sat on the mat and looked at me all day", "en", "a"),
    (1, "The cat sat on the mat and looked at me all day", "en", "a"),  # the same row again
    (2, "The  cat sat\ton the mat and looked at me all day", "en", "b"),  # equal but for blanks
    (3, "the cat sat on the mat and looked at me all night", None, None),
    (4, None, "en", "b"),
    (5, "", "en", None),
    (6, " \n\t ", None, "c"),
    (7, LONG, "en", "a"),
    (8, LONG + " more", "en", "a"),
    (None, "no id here", "en", "a"),
    (None, None, None, None),
    (9, "été ñandú ÄRGER 日本語 idiot", "fr", "c"),
    (10, "été ñandú ÄRGER 日本語 idiot", "fr", "c"),
    (11, "12345 !!! ???", "fr", "\U0001f600"),
]
# Names that operators use for their own columns.
EXTRA = ["copies", "digest", "row", "key", "at", "place", "_place", "words", "size", "n", "doc", "src", "fp", "of", "kept"]


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty, blank and long texts, repeated rows, and columns with clashing names."""
    rows = [(*t, len(t[1] or ""), *["x"] * len(EXTRA)) for t in TEXTS]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(rows, schema + "".join(f", {c} string" for c in EXTRA)).repartition(3)


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of tables from frames, as registered entries read them."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# 1 toxicity


def test_toxicity_learns_and_takes_odd_rows(spark, odd, none):
    good, bad = "a fine day in the park", "you are an idiot and a moron"
    made = [(i, bad if i % 3 == 0 else good, int(i % 3 == 0)) for i in range(90)]
    docs = spark.createDataFrame([(100 + i, f"{t} number {i}") for i, t, _ in made], "doc_id bigint, text string")
    labels = spark.createDataFrame([(100 + i, y) for i, _, y in made], "doc_id bigint, toxic int")
    extra = spark.createDataFrame([(100, 0), (101, None), (None, 1), (7777, 1)], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, labels.union(extra))
    assert rows_of(docs.join(labels, "doc_id").select((model.score(F.col("text")) >= 0.5) == (F.col("toxic") == 1))) == {(True,): 90}
    scored = toxicity.score_toxicity(odd, model)
    assert scored.columns == [*odd.columns, "score"] and scored.count() == odd.count()
    assert all(0 <= r.score <= 1 for r in scored.collect())
    again = toxicity.train_toxicity(docs, labels.union(extra).repartition(5), broadcast_rows=0)
    assert np.allclose(again.weights, model.weights)
    assert toxicity.score_toxicity(none, model).count() == 0
    # One class only, or none: a constant.
    for y, expected in ((1, 1), (0, 0)):
        only = toxicity.train_toxicity(docs, labels.where(F.col("toxic") == y))
        assert {round(r.score) for r in toxicity.score_toxicity(odd, only).collect()} == {expected}
    assert toxicity.train_toxicity(none, labels).bias < 0


def test_long_text_has_the_features_of_its_pieces(monkeypatch):
    grams = toxicity.Grams()
    text = "".join(chr(97 + i * i % 26) for i in range(5000))
    seen = np.zeros(1 << grams.bits, bool)
    whole = grams.mark(text, seen)
    monkeypatch.setattr(toxicity, "_PIECE", 333)
    assert np.array_equal(grams.mark(text, seen), whole) and not seen.any()


# 2 language


def test_language_of_odd_rows(spark, odd, none):
    model = language.train_languages(odd)
    assert model.languages == ["en", "fr"]
    found = odd.select("text", model.predict(F.col("text")).alias("p")).collect()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang == "und") == (not letters) and (r.p.score == 0 or letters) and 0 <= r.p.score <= 1
    nothing = language.train_languages(none)
    assert {r.p.lang for r in odd.select(nothing.predict(F.col("text")).alias("p")).collect()} == {"und"}
    with pytest.raises(ValueError):
        language.train_languages(odd, most=1)


def test_bundles_are_sums_of_bound_vectors():
    space = language.Space(size=64)
    letter = lambda c: np.random.default_rng([space.seed, ord(c)]).integers(0, 2, 64) * 2 - 1
    text = " the cat "
    expected = sum(
        np.roll(letter(text[i]), 2) * np.roll(letter(text[i + 1]), 1) * letter(text[i + 2])
        for i in range(len(text) - 2)
    )
    assert np.array_equal(space.bundles(["The, cat!"])[0], expected)


# 3 decontamination


def hits(text, items, size=10):
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = cut(text), set(), set()
    for item, t in items:
        w = cut(t)
        n = min(size, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_contamination(spark, odd, broadcast_rows):
    items = [
        (1, "cat SAT on the mat and looked at me all day"),
        (2, "sat on the mat and looked at me all day or so"),
        (3, "idiot"),
        (4, "word1 word2"),
        (5, None),
        (6, " . "),
        (None, "no id"),
        (1, "here"),
    ]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, h string")
    found = decontaminate.contamination(odd, bench, broadcast_rows=broadcast_rows)
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(map(str, r["items"]))), r.contaminated) for r in found.collect())
    want = Counter()
    for r in odd.collect():
        n, h, names = hits(r.text, items)
        want[(r.doc_id, n, h, tuple(names), h > 0)] += 1
    assert got == want
    clean = decontaminate.decontaminate(odd, bench, broadcast_rows=broadcast_rows)
    assert clean.columns == odd.columns
    assert rows_of(clean) == Counter(tuple(r) for r in odd.collect() if not hits(r.text, items)[1])
    cut = decontaminate.decontaminate(odd, bench, mode="spans")
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert "été ñandú ÄRGER 日本語" in {r.text for r in cut.collect()}


def test_contamination_of_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([(1, "the cat")], "item_id bigint, text string")
    assert decontaminate.contamination(none, bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(odd, bench.limit(0)).collect()} == {0}
    assert decontaminate.decontaminate(odd, bench.limit(0)).count() == odd.count()


# 4 language model


def test_katz_on_odd_rows(odd, none):
    found = katz.score_texts(odd, F.col("doc_id") % 2 == 1)
    rows = found.collect()
    assert len(rows) == odd.count() and katz.score_texts(none, F.lit(True)).count() == 0
    for r in rows:
        assert r.n_tokens >= 1 and r.n_known <= r.n_tokens and r.score <= 0 and np.isfinite(r.score)
    assert {r.train_tokens for r in rows} == {13 * 3 + 1 + len(LONG.split()) + 1 + 6 + 4}
    untrained = katz.score_texts(odd, F.lit(False)).collect()
    assert {(r.score, r.base_score, r.n_known) for r in untrained} == {(0.0, 0.0, 0)}


def test_discounts():
    d = katz.discounts([100, 40, 25, 18, 14, 11])
    rest = 6 * 11 / 100
    assert np.isclose(d[0], (2 * 40 / 100 - rest) / (1 - rest)) and (0 < d).all() and (d < 1).all()
    for few in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 1, 9, 1, 9]):
        assert ((0 < katz.discounts(few)) & (katz.discounts(few) < 1)).all()


# 5 chat


def test_chat_round_trip(spark, none):
    import random

    rng = random.Random(3)
    bits = ["<|turn|>", "<|text|>", "<|part|>", "<|end|>", "</s>", "[INST]", "[/INST]", "<", "|", "\\", "[", "a", "\n", "é", "<\\|end|>", "$1"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choices(bits, k=rng.randint(0, 8)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "<|end|>", ""]), text, "x"))
    rows += [(None, 1, "user", "x", "x"), (99, 0, None, None, "x"), (99, None, "assistant", "first", "x"), (99, 0, None, None, "x")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, said string")
    made = chat.format_conversations(df.repartition(5))
    read = made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.trained_text(F.col("segments")).alias("l"), "formatted").collect()
    for r in read:
        own = sorted(
            ((-1 if t is None else t, role or "", text or "") for c, t, role, text, _ in rows if c == r.conv_id)
        )
        assert [(t.role, t.text) for t in r.t] == [o[1:] for o in own]
        assert r.l == "".join(text for _, role, text in own if role == "assistant")
        assert r.formatted.count("<|turn|>") == 1 + sum(a[1] != b[1] for a, b in zip(own, own[1:]))
        assert "[INST]" not in r.formatted and "</s>" not in r.formatted
    assert len(read) == 62
    assert chat.format_conversations(df.limit(0)).count() == 0
    for wrong in ({"start": "<<a>"}, {"start": "x"}, {"head": "<|part|>"}, {"end": "<\\x"}):
        with pytest.raises(ValueError):
            chat.ChatTemplate(**wrong)


# 6 token counts


def test_token_counts_of_odd_rows(odd, none):
    hist = tokens.length_histogram(odd, tokens.encoded_length(F.col("text")))
    sums = tokens.suffix_sums(hist)
    assert sums.agg(F.sum("n_docs")).first()[0] == odd.count()
    assert sums.where("length = 0").first().n_docs == 3
    assert tokens.suffix_sums(tokens.length_histogram(none, F.lit(1))).count() == 0
    assert tokens.length_histogram(odd, F.lit(None).cast("bigint")).first().length == 0


# 7 exact duplicates


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(odd, weak):
    import hashlib
    import re

    # With a weak digest most texts collide, and only their bytes tell them apart.
    digest = (lambda sha: F.substring(sha, 1, 0)) if weak else (lambda sha: sha)
    found = exact.exact_duplicates(odd, digest=digest).collect()
    classes = {}
    for r in odd.collect():
        classes.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), []).append(r.doc_id)
    want, keeps = Counter(), Counter()
    for text, ids in classes.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
        keeps[keep] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert Counter(r.doc_id for r in found if r.kept) == keeps


def test_exact_duplicates_in_several_batches(spark, odd, none, tmp_path):
    odd.repartition(6).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    whole, cut = (exact.exact_duplicates(stored, batch_bytes=b) for b in (1 << 30, 1))
    assert rows_of(whole) == rows_of(cut)
    left = exact.drop_exact_duplicates(stored)
    assert left.columns == odd.columns and left.count() == whole.where("kept").count()
    assert exact.exact_duplicates(none).count() == 0 and exact.drop_exact_duplicates(none).count() == 0


# 8 mixing


def test_mix_of_odd_rows(odd, none):
    mixed = mixing.mix(odd)
    assert mixed.count() == odd.count()
    for r in mixed.collect():
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2 and (r["size"] or not r.copies)
    docs = mixing.mixed_documents(odd)
    assert docs.columns == [*odd.columns, "copy"]
    assert docs.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd, total=3.0)


def test_newton_rate(spark):
    df = spark.createDataFrame([(10.0, 20.0), (1e12, 1.0), (5.0, 0.0), (0.0, 0.0), (3.0, 3.0)], "m double, t double")
    rates = [r[0] for r in df.select(mixing.newton_rate(F.col("m"), F.col("t"))).collect()]
    assert np.allclose(rates, [2.0, 1e-12, 0.0, 0.0, 1.0], rtol=1e-9)


# 9 repeated passages


def test_repeats_of_odd_rows(spark, odd, none):
    found = repeats.repeated_passages(odd).collect()
    assert len(found) == odd.count() and repeats.repeated_passages(none).count() == 0
    by = {r.doc_id: r for r in found}
    assert by[7].n_removed == by[7].n_bytes and by[8].n_removed == by[8].n_bytes - len("more")
    assert by[1].n_removed == 0 and by[4].n_bytes == 0 and by[5].spans == []


@pytest.mark.parametrize("size,mean", [(40, 4), (60, 24), (40, 300)])
def test_repeats_on_random_texts(spark, size, mean):
    import random

    rng = random.Random(size + mean)
    pool = ["".join(rng.choices("abcdé ", k=rng.randint(20, 150))) for _ in range(12)]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 5))) + "".join(rng.choices("xyz", k=9)) for _ in range(60)]
    texts += ["a" * 200, "a" * 90, "ab" * 70, texts[3], texts[3]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in repeats.repeated_passages(df, size=size, mean=mean).collect()}
    data = [t.encode() for t in texts]
    seen = Counter(b[p : p + size] for b in data for p in range(len(b) - size + 1))
    for i, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if seen[b[p : p + size]] > 1:
                gone[p : p + size] = True
        spans = [(s["start"], s["end"]) for s in found[i].spans]
        covered = np.zeros(len(b), bool)
        for s, e in spans:
            covered[s:e] = True
        assert np.array_equal(covered, gone) and found[i].n_removed == gone.sum()
    cut = df.join(repeats.repeated_passages(df, size=size, mean=mean), "doc_id")
    for r in cut.select("text", "spans", repeats.cut_spans(F.col("text"), F.col("spans")).alias("left")).collect():
        b, last, left = r.text.encode(), 0, b""
        for s, e in r.spans:
            left += b[last:s]
            last = e
        assert bytes(r.left) == left + b[last:]


# 10 near duplicates


def test_near_duplicates_of_odd_rows(odd, none):
    found = simhash.near_duplicates(odd).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == odd.count() and simhash.near_duplicates(none).count() == 0
    assert by[4].fingerprint == by[5].fingerprint == by[6].fingerprint == "0" * 16
    assert by[4].component_id == by[6].component_id == 4 and by[2].component_id == 1 and by[10].component_id == 9
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert left.count() == len({(r.component_id, r.component_id is None and r.fingerprint) for r in found})


@pytest.mark.parametrize("depth_rows,block", [(65536, 4096), (20, 50), (5, 7)])
def test_all_near_pairs_are_tied(spark, depth_rows, block):
    rng = np.random.default_rng(depth_rows)
    points = list(rng.integers(0, 2**64, 300, dtype=np.uint64))
    for p in points[:120]:  # chains of near points, and points at the radius and just beyond
        for flips in (1, 4, 5):
            for bit in rng.choice(64, flips, replace=False):
                p ^= np.uint64(1) << np.uint64(bit)
            points.append(p)
    values = np.unique(np.array(points, np.uint64))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    links = simhash.near_links(df, leaf_rows=depth_rows, block_rows=block, visitor_rows=block)
    root = {int(v): int(v) for v in values.view(np.int64)}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    signed = values.view(np.int64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ v) <= 4) + i + 1:
            a, b = top(int(signed[i])), top(int(signed[j]))
            root[max(a, b)] = min(a, b)
    found = {r.node: r.root for r in base.components(links).collect()}
    assert {x: found.get(x, x) for x in root} == {x: top(x) for x in root}


def test_components_that_are_stars_end_after_a_round(spark):
    stars = [(r, r * 100 + i) for r in range(1, 4) for i in range(1, 6)] + [(7, 7)]
    links = spark.createDataFrame(stars, "a bigint, b bigint")
    found = {r.node: r.root for r in base.components(links, max_rounds=1).collect()}
    assert found == {n: r for r, n in stars if n != r}


def test_a_round_of_components_runs_each_step_once(spark):
    settings = {"spark.sql.shuffle.partitions": "31", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    links = spark.createDataFrame([(1, i) for i in range(2, 200)], "a bigint, b bigint").repartition(1)
    tracker = spark.sparkContext.statusTracker()
    for k, v in settings.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("components-steps", "")
    try:
        base.components(links, max_rounds=1, hint="merge")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    stages = {s for j in tracker.getJobIdsForGroup("components-steps") for s in tracker.getJobInfo(j).stageIds}
    tasks = [tracker.getStageInfo(s).numCompletedTasks for s in stages if tracker.getStageInfo(s)]
    # Large step, small step, distinct links, the last look: each once over all partitions.
    assert 4 * 31 <= sum(tasks) < 6 * 31, tasks


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5), (1001, 1000)]
    found = {r.node: r.root for r in base.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 1001: 1000}
    assert base.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# The pipeline


def test_every_stage_takes_odd_rows(spark, odd, none, tables):
    labels = spark.createDataFrame([(1, 0), (9, 1), (None, 1)], "doc_id bigint, toxic int")
    bench = spark.createDataFrame([(1, "no id here")], "item_id bigint, text string")
    folder = tables(labels=labels, benchmark=bench)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns + (["copy"] if name == "mix_sources" else []), name
            assert out.where("copy <= 1" if "copy" in out.columns else "true").count() <= docs.count()


def test_pipeline_against_plain_steps(spark):
    """Each stage's decisions, by other means, over the whole smallest tables."""
    import re

    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    (_, toxic), (_, same), (_, near), (_, leaks), (_, mix) = corpus_pipeline.STAGES
    a = kept(toxic(spark, docs, data))
    marked = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("toxic = 1").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in a.collect()}
    assert len(gone & marked) >= len(marked) / 2 and not gone & {
        r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("toxic = 0").collect()
    }
    b = kept(same(spark, a, data))
    first = {}
    for r in sorted(a.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    assert {r.doc_id for r in b.collect()} == set(first.values())
    c = kept(near(spark, b, data))
    heads, _ = brute({r.doc_id: r.text for r in b.collect()})
    assert {r.doc_id for r in c.collect()} == heads
    d = kept(leaks(spark, c, data))
    assert {r.doc_id for r in d.collect()} == {r.doc_id for r in c.collect() if not hits(r.text, items)[1]}
    e = mix(spark, d, data).groupBy("doc_id").count()
    assert rows_of(e) == rows_of(mixing.mix(d).where("copies > 0").select("doc_id", F.col("copies").cast("bigint")))
    assert rows_of(corpus_pipeline.run(spark, data).groupBy("doc_id").count()) == rows_of(e)
