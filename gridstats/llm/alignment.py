"""Alignment of the tokens of two tokenizers over the same bytes.

Each tokenizer gives an incidence matrix of tokens and bytes, in compressed rows. The product of one with
the transposed other, row by row as Gustavson has it, has an entry for each pair of tokens that share bytes:
the overlap links. Where tokens of both end together a group ends; the incidence of tokens and groups gives
links through shared groups in the same way. How many documents hold a pair of ids linked is counted over
the whole corpus, and each document is then held against these counts.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstats.llm.runs import runs
from gridstats.shared import kept

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: how byte-level tokenizers part a text before they merge bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUN_CHARS = 6 << 20
_PART_BYTES = 1 << 20


def _byte_characters() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if it can be seen, else one
    beyond 255 in turn."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """A byte-level vocabulary in the form of a JSON file; control tokens in texts are plain text."""

    def __init__(self, source: bytes):
        import tiktoken

        model = json.loads(source)["model"]
        decode = _byte_characters()

        def data(entry: str) -> bytes:
            return bytes(decode[c] for c in entry)

        pieces = {data(e): i for e, i in model["vocab"].items() if all(c in decode for c in e)}
        # Ranks are the order of the merges, after the single bytes.
        ranks = {p: i for i, p in enumerate(sorted(p for p in pieces if len(p) == 1))}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(data(a + b), len(ranks))
        ids = np.zeros(len(ranks), np.int64)
        for piece, rank in ranks.items():
            ids[rank] = pieces[piece]
        self.encoder = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ids, self.bytes = ids, {i: p for p, i in pieces.items()}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.ids[self.encoder.encode_ordinary(t)] for t in texts]


class PieceBpe:
    """A sentencepiece vocabulary; pieces begin with a lower bar for a space, bytes stand as ``<0xHH>``."""

    def __init__(self, source: bytes):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=source)
        self.bytes = {}
        for i in range(self.encoder.get_piece_size()):
            piece = self.encoder.id_to_piece(i)
            if self.encoder.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            else:
                self.bytes[i] = piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.encoder.encode(texts, num_threads=1)]


@dataclass(frozen=True)
class Rows:
    """A sparse matrix in compressed rows: the columns of row i are ``columns[starts[i] : starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray, column: np.ndarray, n_rows: int) -> Rows:
        """Ones at the places given, which are sorted by row."""
        starts = np.r_[0, np.cumsum(np.bincount(row, minlength=n_rows))]
        return cls(starts, column, np.ones(len(column), np.int64))

    def transposed(self, n_columns: int) -> Rows:
        row = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(self.columns, minlength=n_columns))]
        return Rows(starts, row[order], self.values[order])

    def times(self, other: Rows, n_columns: int) -> Rows:
        """The product: each row is the sum of the other's rows that its columns name, by their values."""
        size = np.diff(other.starts)[self.columns]
        ends = np.cumsum(size)
        at = np.repeat(other.starts[self.columns] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        row = np.repeat(np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), size)
        key = row * n_columns + other.columns[at]
        value = np.repeat(self.values, size) * other.values[at]
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        starts = np.r_[0, np.cumsum(np.bincount(key[first] // n_columns, minlength=len(self.starts) - 1))]
        return Rows(starts, key[first] % n_columns, np.add.reduceat(value, first) if len(first) else value)


def token_bytes(sizes: np.ndarray) -> Rows:
    """Incidence of tokens, in order, and the bytes that they cover."""
    return Rows(np.r_[0, np.cumsum(sizes)], np.arange(sizes.sum()), np.ones(sizes.sum(), np.int64))


@dataclass(frozen=True)
class Aligned:
    """Tokens of both sides over the same bytes: overlap links with their shared bytes, group of each token."""

    link_a: np.ndarray
    link_b: np.ndarray
    shared: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    def group_links(self) -> Rows:
        """Per token of A the tokens of B in the same group; as many as groups have pairs, so for short texts."""
        n = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        a = Rows.of(np.arange(len(self.group_a)), self.group_a, len(self.group_a))
        b = Rows.of(np.arange(len(self.group_b)), self.group_b, len(self.group_b))
        return a.times(b.transposed(n), max(1, len(self.group_b)))


def align(size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Links and groups of tokens that cover the same bytes, from the bytes that each token has."""
    a, b = token_bytes(size_a), token_bytes(size_b)
    product = a.times(b.transposed(int(size_b.sum())), max(1, len(size_b)))
    link_a = np.repeat(np.arange(len(size_a)), np.diff(product.starts))
    end_a, end_b = a.starts[1:], b.starts[1:]
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    return Aligned(link_a, product.columns, product.values, group_a, group_b)


class Aligner:
    """Both tokenizers, and the tables to turn their tokens into bytes and into the text of groups."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        self.sides = (ByteBpe(byte_bpe), PieceBpe(piece_bpe))
        self.sizes, self.n_ids, shown = [], [], []
        for side, last in zip(self.sides, "|;"):
            n = max(side.bytes) + 1
            sizes = np.zeros(n, np.int64)
            for i, piece in side.bytes.items():
                sizes[i] = len(piece)
            self.sizes.append(sizes)
            self.n_ids.append(n)
            shown += [[f"{i}," for i in range(n)], [f"{i}{last}" for i in range(n)]]
        self.shown = [s for one in shown for s in one]
        self.code_type = "<u4" if self.n_ids[0] * self.n_ids[1] <= 1 << 32 else "<u8"

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for each text, none where the bytes of a side are not a space and the text."""
        said = [t or "" for t in texts]
        ids = [self.sides[0].encode([" " + t for t in said]), self.sides[1].encode(said)]
        none = np.empty(0, np.int64)
        for i, t in enumerate(said):
            whole = (" " + t).encode()
            if not t or any(
                b"".join(map(side.bytes.__getitem__, own[i].tolist())) != whole for side, own in zip(self.sides, ids)
            ):
                ids[0][i] = ids[1][i] = none
        return ids[0], ids[1]

    def group_text(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
        """``a1,a2|b1;`` ... in pieces, a piece for each token."""
        n_a, n_b = self.n_ids  # ``shown`` has A inside a group, A last, B inside, B last
        code = np.r_[
            a + n_a * np.r_[group_a[1:] != group_a[:-1], True][: len(a)],
            2 * n_a + b + n_b * np.r_[group_b[1:] != group_b[:-1], True][: len(b)],
        ]
        order = np.argsort(np.r_[2 * group_a, 2 * group_b + 1], kind="stable")
        return list(map(self.shown.__getitem__, code[order].tolist()))


def _parts(texts: list[str | None]) -> Iterator[slice]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _PART_BYTES:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


_DOC = "n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string"


def _aligned_rows(texts: list[str | None], aligner: Aligner) -> list[tuple]:
    """Per text the columns of ``_DOC``, the distinct pairs of ids linked and how often each."""
    a, b = aligner.tokens(texts)
    n_a, n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    all_a, all_b = np.concatenate(a), np.concatenate(b)
    got = align(aligner.sizes[0][all_a], aligner.sizes[1][all_b])
    code = all_a[got.link_a] * aligner.n_ids[1] + all_b[got.link_b]
    shown = aligner.group_text(all_a, all_b, got.group_a, got.group_b)
    end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
    end_link = np.searchsorted(got.link_a, end_a)
    n_groups = int(got.group_a[-1]) + 1 if len(got.group_a) else 0
    pairs = np.r_[0, np.cumsum(np.bincount(got.group_a, minlength=n_groups) * np.bincount(got.group_b, minlength=n_groups))]
    rows, link, group, piece = [], 0, 0, 0
    for i in range(len(texts)):
        codes, times = np.unique(code[link : end_link[i]], return_counts=True)
        links = int(end_link[i]) - link
        link = int(end_link[i])
        last = int(got.group_a[end_a[i] - 1]) + 1 if n_a[i] else group
        n = int(n_a[i] + n_b[i])
        text = "".join(shown[piece : piece + n])[:-1]
        piece += n
        sha = hashlib.sha256(text.encode()).hexdigest() if n else ""
        held = (int(n_a[i]), int(n_b[i]), last - group, links, int(pairs[last] - pairs[group]), sha)
        rows.append((*held, codes.astype(aligner.code_type).tobytes(), times.astype("<u4").tobytes()))
        group = last
    return rows


def align_tokens(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    byte_bpe: str = BYTE_BPE,
    piece_bpe: str = PIECE_BPE,
) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links``.

    A text with a space before it is tokenized by both vocabularies, control strings as plain text. A and B
    tokens whose bytes overlap are linked. The count of a pair of ids is the number of rows of the whole
    table that hold it linked; ``n_best`` are a text's links whose count is the highest of their A id, ties
    included, ``count_sum`` the counts of all its links. Groups end where tokens of both end together;
    ``n_group_links`` are the pairs of tokens that share a group. Null and empty texts, and such as a side
    cannot write back byte by byte, have no tokens: zeros and an empty digest. Rows with equal texts count
    each; null ids are kept; an empty table gives no rows; other columns are not read. The tokens of one
    text lie in one task, about 200 times its bytes; the files of the vocabularies are read here and shipped.
    """
    files = Path(byte_bpe).read_bytes(), Path(piece_bpe).read_bytes()
    aligner = Aligner(*files)
    n_b, code_type = F.lit(aligner.n_ids[1]).cast("bigint"), aligner.code_type

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(*files)  # made anew, as encoders cannot be shipped
        names = [c.split()[0] for c in _DOC.split(", ")]
        for run, rows in runs(batches, "_text", _RUN_CHARS):
            texts, made = rows["_text"].tolist(), []
            for part in _parts(texts):
                made += _aligned_rows(texts[part], aligner)
            out = pd.DataFrame(made, columns=[*names, "codes", "times"])
            yield pd.concat([rows[["_row"]], out], axis=1).assign(run=run)

    source = docs.select(F.struct(F.col(doc_id).alias("doc")).alias("_row"), F.col(text).alias("_text"))
    row_type = source.schema["_row"].dataType.simpleString()
    shape = f"_row {row_type}, {_DOC}, codes binary, times binary, run long"
    aligned = kept(source.mapInPandas(encode, shape), "aligned")

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, held = None, []

        def flush() -> pd.DataFrame:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"run": run, "code": codes.astype(np.int64), "n_docs": n})

        for batch in batches:
            for next_run, codes in zip(batch["run"], batch["codes"]):
                if next_run != run and held:
                    yield flush()
                    held = []
                run = next_run
                held.append(np.frombuffer(codes, code_type))
        if held:
            yield flush()

    in_runs = kept(aligned.select("run", "codes").mapInPandas(distinct, "run long, code long, n_docs long"), "pairs")
    counts = in_runs.groupBy("code").agg(F.sum("n_docs").alias("count"))
    counts = kept(counts.withColumn("a", F.expr("code") - F.pmod("code", n_b)), "counts")
    # A row for each A id, of which the vocabulary has a fixed number.
    best = counts.groupBy(F.col("a").alias("of_a")).agg(F.max("count").alias("most"))
    known = counts.join(F.broadcast(best), F.col("a") == F.col("of_a")).select(
        F.col("code").alias("of_code"), "count", (F.col("count") == F.col("most")).alias("best")
    )
    asked = in_runs.select("run", "code").join(known, F.col("code") == F.col("of_code"))
    asked = asked.select(F.col("run").alias("of_run"), "code", "count", "best")

    def judge(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pairs["code"].to_numpy(np.int64))
        code = pairs["code"].to_numpy(np.int64)[order]
        count, is_best = pairs["count"].to_numpy(np.int64)[order], pairs["best"].to_numpy(bool)[order]
        n_best, sums = [], []
        for codes, times in zip(texts["codes"], texts["times"]):
            at = np.searchsorted(code, np.frombuffer(codes, code_type).astype(np.int64))
            n = np.frombuffer(times, "<u4").astype(np.int64)
            n_best.append(int((n * is_best[at]).sum()) if len(n) else 0)
            sums.append(int((n * count[at]).sum()) if len(n) else 0)
        return texts.drop(columns=["codes", "times", "run"]).assign(n_best=n_best, count_sum=sums)

    both = aligned.groupBy("run").cogroup(asked.groupBy("of_run"))
    judged = both.applyInPandas(judge, f"_row {row_type}, {_DOC}, n_best long, count_sum long")
    return judged.select(
        F.col("_row.doc").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256", "n_group_links",
    )
