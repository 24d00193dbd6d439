"""Alignment of tokens against plain loops over another library's tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gridstats.llm import alignment
from gridstats.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plain(texts):
    """Per place in ``texts`` the columns of the operator, by loops over all pairs of tokens."""
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    letters = {}
    for i in range(256):
        letters.setdefault(i, None)
    shown = [i for i in range(256) if 33 <= i <= 126 or 161 <= i <= 172 or i >= 174]
    decode = {chr(i): i for i in shown}
    decode |= {chr(256 + n): i for n, i in enumerate(i for i in range(256) if i not in shown)}
    made = []
    for t in texts:
        tokens = [[], []]
        if t:
            for i in a.encode(" " + t, add_special_tokens=False).ids:
                tokens[0].append((i, bytes(decode[c] for c in a.id_to_token(i))))
            for i in b.encode(t):
                p = b.id_to_piece(i)
                tokens[1].append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
            if any(b"".join(x for _, x in own) != (" " + t).encode() for own in tokens):
                tokens = [[], []]
        spans = []
        for own in tokens:
            at, found = 0, []
            for i, x in own:
                found.append((i, at, at + len(x)))
                at += len(x)
            spans.append(found)
        links, first = [], 0
        for i, s, e in spans[0]:
            while first < len(spans[1]) and spans[1][first][2] <= s:
                first += 1
            k = first
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for c in cuts:
            groups.append([[i for i, s, e in own if low < e <= c] for own in spans] if len(spans[0]) < 3000 else None)
            low = c
        made.append((spans, links, groups))
    held = Counter(x for _, links, _ in made for x in set(links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(n, most.get(i, 0))
    rows = []
    for spans, links, groups in made:
        if None in groups:
            sha = None
        else:
            said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            sha = hashlib.sha256(said.encode()).hexdigest() if spans[0] else ""
        pairs = sum(len(x) * len(y) for x, y in groups) if None not in groups else None
        best = sum(held[x] == most[x[0]] for x in links)
        rows.append((len(spans[0]), len(spans[1]), len(groups), len(links), best, sum(held[x] for x in links), sha, pairs))
    return rows


ODD = [
    "One two three", None, "", " ", "  two  blanks ", "\n", "tab\tand\r\nline", "<|endoftext|> and </s> <s> <unk> <0x41>",
    "Äpfel 中文字 ▁ bar 😀😀 é ​ x", "\x00\x01", "a" * 500, "ﬁ ½ İ K", "One two three", "don't we'll 12,345.67",
    "मानक हिन्दी العربية", "word " * 4000, "　wide", "x", "🏳️‍🌈" * 20,
]


def got(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}


def agree(found, expected):
    assert len(found) == len(expected)
    for f, e in zip(found, expected):
        assert all(y is None or x == y for x, y in zip(f, e)), (f, e)


@pytest.mark.parametrize("chars,part,parts", [(6 << 20, 1 << 20, 3), (40, 10, 2)])
def test_odd_texts(spark, monkeypatch, chars, part, parts):
    monkeypatch.setattr(alignment, "_RUN_CHARS", chars)
    monkeypatch.setattr(alignment, "_PART_BYTES", part)
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "no id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run string, code long").repartition(parts)
    found = got(alignment.align_tokens(df))
    agree([found[i] for i in [*range(len(ODD)), None]], plain([*ODD, "no id"]))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    found = got(QUERIES["op11_align_tokens"](spark, DATA))
    agree([found[r.doc_id] for r in docs], plain([r.text for r in docs]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert alignment.align_tokens(df).collect() == []


def test_product_of_rows():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 3, (7, 11)) * rng.integers(0, 2, (7, 11)), rng.integers(0, 2, (11, 5))

    def rows(m):
        r, c = np.nonzero(m)
        made = alignment.Rows.of(r, c, len(m))
        return alignment.Rows(made.starts, made.columns, m[r, c])

    product, dense = rows(x).times(rows(y), 5), np.zeros((7, 5), int)
    for i in range(7):
        part = slice(product.starts[i], product.starts[i + 1])
        dense[i, product.columns[part]] = product.values[part]
    assert (dense == x @ y).all()
    back = rows(x).transposed(11)
    assert back.starts[-1] == np.count_nonzero(x) and (np.diff(back.starts) == (x != 0).sum(axis=0)).all()


def test_links_through_groups():
    got_ = alignment.align(np.array([3, 2, 4]), np.array([2, 3, 1, 3]))
    assert list(zip(got_.link_a.tolist(), got_.link_b.tolist(), got_.shared.tolist())) == [
        (0, 0, 2), (0, 1, 1), (1, 1, 2), (2, 2, 1), (2, 3, 3),
    ]
    links = got_.group_links()
    assert np.diff(links.starts).tolist() == [2, 2, 2] and links.columns.tolist() == [0, 1, 0, 1, 2, 3]
