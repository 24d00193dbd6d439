"""Repeated passages by prefix-free parsing.

A rolling hash over the bytes of a text sets triggers; the text between two triggers, with the trigger
before it, is a phrase. Phrases depend on content only: where a passage occurs again, so do the phrases in
it. The dictionary, that is the phrases of all distinct texts, is counted first: a string that holds a
phrase with a single occurrence has a single occurrence itself. Of the strings of ``size`` bytes that are
left, equal ones are found by sorting their 96-bit hashes in buckets. Texts are gathered in runs of some
megabytes; a run asks once for each hash it has, however often it has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.runs import by_bucket, kept_runs, runs
from gridstats.shared import kept

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_WINDOW = 16
_RUN_BYTES = 4 << 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    return h ^ (h >> _U(29))


class Rolling:
    """Hashes of any part of a text from sums over its prefixes, modulo 2 ** 64."""

    def __init__(self, seed: int = 0):
        self.values = np.random.default_rng([2024, seed]).integers(0, 2**64, 256, dtype=np.uint64)
        self.step = _U(_MULTIPLIER + 2 * seed)
        self.back = _U(pow(int(self.step), -1, 2**64))
        self.power = self.inverse = np.ones(1, np.uint64)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.power):
            n = 2 * len(data) + 1
            self.power = np.cumprod(np.r_[_U(1), np.full(n, self.step)])
            self.inverse = np.cumprod(np.r_[_U(1), np.full(n, self.back)])
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.inverse[start])

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return _mixed((sums[size:] - sums[:n]) * self.inverse[:n])

    def triggers(self, sums: np.ndarray, mean: int) -> np.ndarray:
        """Ends of the windows whose hash falls below a share of one in ``mean``."""
        high = self.windows(sums, _WINDOW) >> _U(32)
        return np.flatnonzero(high < _U(2**32 // mean)) + _WINDOW

    def phrases(self, sums: np.ndarray, triggers: np.ndarray) -> np.ndarray:
        """Hashes of the phrases between triggers, each with the trigger's window before it."""
        return self.of(sums, triggers[:-1] - _WINDOW, triggers[1:])


def open_places(n: int, triggers: np.ndarray, repeated: np.ndarray, size: int) -> np.ndarray:
    """Starts of strings of ``size`` bytes that hold no phrase with a single occurrence."""
    alone = ~repeated
    low = np.maximum(triggers[1:][alone] - size, 0)
    high = np.minimum(triggers[:-1][alone] - _WINDOW, n - size)
    holds = low <= high
    change = np.zeros(n - size + 2, np.int64)
    np.add.at(change, low[holds], 1)
    np.add.at(change, high[holds] + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:-1] == 0)


def _utf8(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _as_runs(places: np.ndarray) -> bytes:
    """Sorted places as runs of places next to each other: starts, then lengths."""
    starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1] + 1])
    lengths = np.diff(np.r_[starts, len(places)])
    return np.stack([places[starts], lengths]).astype("<i8").tobytes()


def _from_runs(data: bytes) -> np.ndarray:
    starts, lengths = np.frombuffer(data, "<i8").reshape(2, -1)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def _cuts(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values."""
    starts = np.flatnonzero(np.r_[True, order[1:] != order[:-1]]) if len(order) else np.empty(0, int)
    return starts, np.r_[starts[1:], len(order)].astype(int)


def _once_or_more(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of a run, where each value is among them, and which occur more than once."""
    found, at, n = np.unique(values, return_inverse=True, return_counts=True)
    return found, at, n > 1


def _deal(found: np.ndarray, more: np.ndarray, buckets: int, run: int, others: np.ndarray | None = None) -> pd.DataFrame:
    """A row for each bucket of a run's distinct hashes: the bits that travel, and which are there twice.

    A value is sent once however often the run has it, so frequent ones make no bucket large.
    """
    bucket = (found % _U(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    rows = []
    for s, e in zip(*_cuts(bucket[by])):
        own = by[s:e]
        high = (found[own] >> _U(32)).astype("<u4").tobytes() if others is None else found[own].tobytes()
        low = b"" if others is None else others[own].tobytes()
        rows.append((int(bucket[own[0]]), run, high, low, np.packbits(more[own]).tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "run", "hashes", "others", "more"])


_DEALT = "bucket long, run long, hashes binary, others binary, more binary"


def _met(parts: pd.DataFrame) -> pd.DataFrame:
    """For each run of a bucket, which of its hashes occur more than once in all runs together."""
    wide = len(parts["others"].iloc[0]) > 0
    hashes = [np.frombuffer(h, "<u8" if wide else "<u4") for h in parts["hashes"]]
    sizes = [len(h) for h in hashes]
    more = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(parts["more"], sizes)])
    values = np.concatenate(hashes)
    if wide:
        others = np.concatenate([np.frombuffer(o, "<u4") for o in parts["others"]])
        order = np.lexsort((others, values))
        new = np.r_[True, (values[order][1:] != values[order][:-1]) | (others[order][1:] != others[order][:-1])]
    else:
        order = np.argsort(values, kind="stable")
        new = np.r_[True, values[order][1:] != values[order][:-1]]
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    twice = (np.bincount(at, 1 + more.astype(np.int64)) > 1)[at]
    ends = np.cumsum(sizes)
    bits = [np.packbits(twice[e - n : e]).tobytes() for n, e in zip(sizes, ends)]
    return pd.DataFrame({"of_run": parts["run"], "bucket": parts["bucket"], "twice": bits})


_ANSWER = "of_run long, bucket long, twice binary"


def _answered(found: np.ndarray, rows: pd.DataFrame, buckets: int) -> np.ndarray:
    """The answers to a run's distinct hashes, in their order."""
    bucket = (found % _U(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    of = dict(zip(rows["bucket"].tolist(), rows["twice"]))
    twice = np.zeros(len(found), bool)
    for s, e in zip(*_cuts(bucket[by])):
        twice[by[s:e]] = np.unpackbits(np.frombuffer(of[int(bucket[by[s]])], np.uint8), count=e - s).astype(bool)
    return twice


def _run_phrases(texts: list[str], mean: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Triggers and phrase hashes of each text of a run."""
    roll, triggers, phrases = Rolling(), [], []
    for text in texts:
        sums = roll.prefixes(_utf8(text))
        triggers.append(roll.triggers(sums, mean))
        phrases.append(roll.phrases(sums, triggers[-1]))
    return triggers, phrases


def _run_strings(texts: list[str], places: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64 and 32 bits of the hashes of the strings at the open places of a run, and how many each text has."""
    rolls, found, n = [Rolling(1), Rolling(2)], [[], []], []
    for text, own in zip(texts, places):
        data, at = _utf8(text), _from_runs(own)
        for roll, to in zip(rolls, found):
            to.append(roll.of(roll.prefixes(data), at, at + size))
        n.append(len(at))
    first, second = np.concatenate(found[0]), np.concatenate(found[1])
    return first, (second >> _U(32)).astype("<u4"), np.array(n, np.int64)


def _distinct_strings(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, in order, where each string is among them, and which occur more than once."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return a[new], b[new], at, np.bincount(at) > 1


def spans_of(starts: np.ndarray, size: int) -> np.ndarray:
    """Maximal runs ``[start, end)`` of bytes that strings of ``size`` from sorted starts cover."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    first = np.r_[True, starts[1:] > starts[:-1] + size]
    last = np.r_[first[1:], True]
    return np.stack([starts[first], starts[last] + size], axis=1)


def repeated_passages(
    docs: DataFrame,
    size: int = 400,
    mean: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, spans, kept_sha256``.

    Texts are UTF-8 bytes, null is empty. A byte counts as removed if a string of ``size`` bytes over it
    also starts at any other place, in the same text or another; matches do not cross texts, overlaps
    count, and what is removed elsewhere makes no difference. ``spans`` are the maximal removed runs
    ``(start, end)``, ``kept_sha256`` the digest of the bytes that are left. A text that occurs in two
    rows repeats as a whole if it has ``size`` bytes. Texts are read once per distinct content after the
    first pass, so copies cost nothing more. ``mean`` is the mean length of a phrase; the result does not
    depend on it. A task holds a run of 4 MB of texts or a single longer one, at about 60 times its bytes, or
    a bucket of about ``bucket_bytes`` of text; a string that is everywhere is there once for each run.
    """
    if size < 2 * _WINDOW:
        raise ValueError(f"size must be at least {2 * _WINDOW}")
    whole = F.coalesce(F.col(text), F.lit(""))
    row = docs.select(
        F.col(doc_id).alias("doc"),
        F.unhex(F.md5(whole.cast("binary"))).alias("text_id"),
        F.octet_length(whole).cast("bigint").alias("n_bytes"),
        F.sha2(whole, 256).alias("sha"),
        whole.alias("text"),
    )
    rows = kept(row.drop("text"), "texts")
    long_rows = row.where(F.col("n_bytes") >= size).select("text_id", "text")
    volume = rows.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, -(-volume // bucket_bytes))
    n_runs = max(8, -(-volume // _RUN_BYTES))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, held in runs(batches, "text", _RUN_BYTES):
            row = (number, b"".join(map(bytes, held["text_id"])), held["text"].tolist())
            yield pd.DataFrame([row], columns=["run", "ids", "texts"])

    texts = long_rows.groupBy("text_id").agg(F.first("text").alias("text"))
    shape = "run long, ids binary, texts array<string>"
    run_table = kept_runs(texts.mapInPandas(gather, shape), n_runs, "texts")

    def ask_phrases(own: pd.DataFrame) -> pd.DataFrame:
        _, phrases = _run_phrases(list(own["texts"].iloc[0]), mean)
        found, _, more = _once_or_more(np.concatenate(phrases))
        return _deal(found, more, buckets, int(own["run"].iloc[0]))

    def leave(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        texts = list(own["texts"].iloc[0])
        triggers, phrases = _run_phrases(texts, mean)
        found, at, _ = _once_or_more(np.concatenate(phrases))
        repeated, ids, start = _answered(found, rows, buckets)[at], own["ids"].iloc[0], 0
        held: list[tuple[bytes, str, bytes]] = []
        for i, (text, marks, own_phrases) in enumerate(zip(texts, triggers, phrases)):
            places = open_places(len(text.encode()), marks, repeated[start : start + len(own_phrases)], size)
            start += len(own_phrases)
            if len(places):
                held.append((ids[16 * i : 16 * i + 16], text, _as_runs(places)))
        rows = [(int(own["run"].iloc[0]), b"".join(h[0] for h in held), [h[1] for h in held], [h[2] for h in held])]
        return pd.DataFrame(rows if held else [], columns=["run", "ids", "texts", "places"])

    # By run, though each has one row: a batch of rows could hold many runs.
    answers = run_table.groupBy("run").applyInPandas(ask_phrases, _DEALT)
    answers = by_bucket(answers, buckets).applyInPandas(_met, _ANSWER)
    left = run_table.groupBy("run").cogroup(answers.groupBy("of_run"))
    open_runs = kept_runs(left.applyInPandas(leave, f"{shape}, places array<binary>"), n_runs, "open")
    parts = 4 * buckets

    def ask_strings(own: pd.DataFrame) -> pd.DataFrame:
        first, second, _ = _run_strings(list(own["texts"].iloc[0]), list(own["places"].iloc[0]), size)
        first, second, _, more = _distinct_strings(first, second)
        return _deal(first, more, parts, int(own["run"].iloc[0]), second)

    def cut(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        texts, places, ids = list(own["texts"].iloc[0]), list(own["places"].iloc[0]), own["ids"].iloc[0]
        first, second, n = _run_strings(texts, places, size)
        first, second, at, _ = _distinct_strings(first, second)
        twice, start, made = _answered(first, rows, parts)[at], 0, []
        for i, text in enumerate(texts):
            spans = spans_of(_from_runs(places[i])[twice[start : start + n[i]]], size).tolist()
            start += n[i]
            if not spans:
                continue
            data, keep, end = text.encode(), hashlib.sha256(), 0
            for s, e in spans:
                keep.update(data[end:s])
                end = e
            keep.update(data[end:])
            made.append((ids[16 * i : 16 * i + 16], [{"start": s, "end": e} for s, e in spans], keep.hexdigest()))
        return pd.DataFrame(made, columns=["of", "found", "left"])

    answers = open_runs.groupBy("run").applyInPandas(ask_strings, _DEALT)
    answers = by_bucket(answers, parts).applyInPandas(_met, _ANSWER)
    both = open_runs.groupBy("run").cogroup(answers.groupBy("of_run"))
    removed = both.applyInPandas(cut, "of binary, found array<struct<start:long,end:long>>, left string")
    copies = rows.groupBy("text_id").agg(F.count("*").alias("copies")).where("copies > 1")
    copies = copies.select(F.col("text_id").alias("copied"))
    joined = rows.join(removed, F.col("text_id") == F.col("of"), "left")
    joined = joined.join(copies, F.col("text_id") == F.col("copied"), "left")
    all_of_it = F.col("copied").isNotNull() & (F.col("n_bytes") >= size)
    entire = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.when(all_of_it, entire).otherwise(F.coalesce("found", none))
    left = F.when(all_of_it, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("left", "sha"))
    gone = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return joined.select(
        F.col("doc").alias(doc_id),
        "n_bytes",
        gone.alias("n_removed"),
        spans.alias("spans"),
        left.alias("kept_sha256"),
    )


def cut_spans(text: Column, spans: Column) -> Column:
    """The bytes of a text outside its spans; a span may end within a character, hence binary."""
    whole = F.coalesce(text, F.lit("")).cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(
        F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(whole).cast("bigint"))
    )
    between = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))

    def piece(b: Column) -> Column:
        length = (b["end"] - b["start"]).cast("int")
        return F.hex(F.substring(whole, (b["start"] + 1).cast("int"), length))

    return F.unhex(F.array_join(F.transform(between, piece), ""))
