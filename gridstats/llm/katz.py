"""Katz backoff language model of words, of any order.

Counts are Good-Turing discounted; what discounts free goes to unseen followers of a context in proportion
to their probability after the context without its first word, with weights that make every distribution
sum to one. Words and contexts travel as 64-bit hashes. Texts are gathered in runs of some megabytes, and a
run asks once for each n-gram it has: the n-grams of one order meet in buckets of their contexts, where
counts of all runs are summed and each run gets its answers, order after order. Contexts that are frequent
are parted by follower. A run then scores its texts token by token, from the highest order down.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm.repeats import Rolling, _cuts
from gridstats.llm.runs import by_bucket, kept_runs, packed, runs, unpacked
from gridstats.shared import new_folder

_U = np.uint64
START, END = _U(0x5354415254), _U(0x454E44)
TOP = 5  # counts above are taken as they are, but for _FLOOR
_FLOOR = 1e-3  # left by each such count, so that every context has something for unseen followers
_RUN_CHARS = 8 << 20
_FREQUENT = 1 << 18  # times from which on a context is parted by follower


def word_hashes(text: str | None, roll: Rolling, blank: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased, and of its end."""
    data = np.frombuffer((text or "").encode().lower(), np.uint8)
    edges = np.diff(np.concatenate([[True], blank[data], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return np.array([END])
    return np.append(roll.of(roll.prefixes(data), starts, ends), END)


def _blanks() -> np.ndarray:
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return blank


def discounts(seen: list[int]) -> np.ndarray:
    """Discounts of the counts 1 to ``TOP`` from how many n-grams have counts 1 to ``TOP + 1``.

    Good-Turing as Katz has it; where the numbers are too few for that (a discount not between 0 and 1),
    a constant is subtracted from each count instead.
    """
    n = np.array(seen[: TOP + 1], float)
    r = np.arange(1, TOP + 1)
    if (n > 0).all():
        rest = (TOP + 1) * n[TOP] / n[0]
        d = ((r + 1) * n[1:] / (r * n[:-1]) - rest) / (1 - rest) if rest != 1 else np.zeros(TOP)
        if (d > 0).all() and (d < 1).all():
            return d
    less = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return (r - less) / r


def _classes(counts: np.ndarray) -> list[int]:
    """How many have counts 1 to TOP + 1, and how many above TOP."""
    return [*np.bincount(np.minimum(counts, TOP + 2), minlength=TOP + 2)[1 : TOP + 2].tolist(), int((counts > TOP).sum())]


def _planes(ids: np.ndarray) -> bytes:
    """Numbers as one plane for each byte; the higher planes of numbers that are mostly small pack well."""
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    return sum(p.astype(np.int64) << (8 * i) for i, p in enumerate(planes))


def _joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context and the word after it."""
    h = (context * _U(0x9E3779B97F4A7C15) + word) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(29))


EMPTY = np.zeros(1, _U)


def _all_start(order: int) -> np.ndarray:
    """The context of the first word of a text."""
    context = EMPTY
    for _ in range(order - 1):
        context = _joined(context, np.array([START]))
    return context


@dataclass(frozen=True)
class Level:
    """What is known of an order once its n-grams are counted."""

    seen: tuple[int, ...]  # n-grams with counts 1 to TOP + 1, and above TOP
    tokens: int
    words: int
    frequent: np.ndarray  # contexts of the next order that are parted by follower, sorted
    parted: dict[int, tuple]  # contexts of this order that were: total, classes of followers, probability

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        d = np.r_[0.0, discounts(list(self.seen)) * np.arange(1, TOP + 1)]
        return np.where(counts <= TOP, d[np.minimum(counts, TOP)], counts - _FLOOR)

    def freed(self) -> np.ndarray:
        """By how much a follower of each class is lowered."""
        return np.r_[np.arange(1, TOP + 1) * (1 - discounts(list(self.seen))), _FLOOR]


@dataclass
class Run:
    """Texts of a run: vocabulary, tokens, and where each text begins."""

    words: np.ndarray
    tokens: np.ndarray
    starts: np.ndarray
    train: np.ndarray  # of each token

    @classmethod
    def of(cls, row) -> Run:
        lengths = unpacked(row.lengths)
        train = np.array([d["train"] for d in row.docs], bool)
        starts = np.cumsum(lengths) - lengths
        return cls(np.frombuffer(row.words, _U), _from_planes(row.tokens), starts, np.repeat(train, lengths))

    def contexts(self, order: int) -> np.ndarray:
        """Hash of the ``order - 1`` words before each token."""
        context, word = np.broadcast_to(EMPTY, len(self.tokens)), self.words[self.tokens]
        for n in range(1, order):
            longer = np.empty(len(word), _U)
            longer[1:] = _joined(context[:-1], word[:-1])
            longer[self.starts] = _all_start(n + 1)[0]
            context = longer
        return context


@dataclass
class Entries:
    """The distinct n-grams of a run in the order in which they travel."""

    of_token: np.ndarray
    context: np.ndarray
    word: np.ndarray
    bucket: np.ndarray
    first: np.ndarray  # a token of each

    @classmethod
    def of(cls, run: Run, order: int, frequent: np.ndarray, buckets: int) -> Entries:
        context, word = run.contexts(order), run.words[run.tokens]
        _, first, at = np.unique(_joined(context, word), return_index=True, return_inverse=True)
        context, word = context[first], word[first]
        bucket = _buckets(context, word, order, frequent, buckets)
        by = np.lexsort((context, bucket))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        return cls(place[at], context[by], word[by], bucket[by], first[by])


def _is_in(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _buckets(context: np.ndarray, word: np.ndarray, order: int, frequent: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets go by context, and by follower too where the context is frequent or empty."""
    parted = _is_in(context, frequent) if order > 1 else np.ones(len(context), bool)
    return (_joined(context, np.where(parted, word, _U(0))) % _U(buckets)).astype(np.int64)


_PART = (
    "bucket long, run long, contexts binary, followers binary, words binary, counts binary, times binary,"
    " shorter binary, shorter_totals binary"
)
_COUNTED = (
    "kind string, run long, bucket long, counts binary, totals binary, open binary, classes binary,"
    " owed binary, contexts binary, n long, distinct long, followers binary, words binary, shorter binary,"
    " shorter_totals binary"
)
_BINARY = [c.split()[0] for c in _COUNTED.split(", ") if c.endswith(" binary")]
_MODEL = -1  # the run that stands for a kept model


def _asked(run: Run, number: int, order: int, known: _Answers | None, levels: Sequence[Level], buckets: int) -> pd.DataFrame:
    """The n-grams of a run, a row for each bucket."""
    e = Entries.of(run, order, levels[-1].frequent if levels else EMPTY[:0], buckets)
    n = np.bincount(e.of_token, run.train, len(e.first)).astype(np.int64)
    times = np.bincount(e.of_token, minlength=len(e.first))
    shorter = known.counts(order - 1)[e.first] if known else np.zeros(len(n), np.int64)
    totals = known.totals(order - 1)[e.first] if known else np.zeros(len(n), np.int64)
    rows = []
    for s, end in zip(*_cuts(e.bucket)):
        c, c_end = _cuts(e.context[s:end])
        rows.append(
            (
                int(e.bucket[s]), number, e.context[s:end][c].tobytes(), packed(c_end - c), e.word[s:end].tobytes(),
                packed(n[s:end]), packed(times[s:end]), packed(shorter[s:end]), packed(totals[s:end][c]),
            )
        )
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PART.split(", ")])


def _counted(parts: pd.DataFrame, order: int, frequent: np.ndarray, lower: Level | None, keep: bool) -> pd.DataFrame:
    """All runs' n-grams of one bucket: answers to each run, classes of counts, frequent n-grams, and with
    ``keep`` the n-grams themselves."""
    followers = [unpacked(f) for f in parts["followers"]]
    contexts = [np.frombuffer(c, _U) for c in parts["contexts"]]
    context = np.concatenate([np.repeat(c, f) for c, f in zip(contexts, followers)])
    word = np.concatenate([np.frombuffer(w, _U) for w in parts["words"]])
    gram, first, at = np.unique(_joined(context, word), return_index=True, return_inverse=True)
    counts = np.bincount(at, np.concatenate([unpacked(c) for c in parts["counts"]]), len(gram)).astype(np.int64)
    times = np.bincount(at, np.concatenate([unpacked(c) for c in parts["times"]]), len(gram)).astype(np.int64)
    of, inside = np.unique(context[first], return_inverse=True)
    total = np.bincount(inside, counts, len(of)).astype(np.int64)
    kinds = np.minimum(counts, TOP + 1)
    classes = np.stack([np.bincount(inside, kinds == r, len(of)) for r in range(1, TOP + 2)]).astype(np.int64)
    owed = np.zeros(len(of))
    if lower is not None:
        shorter = np.concatenate([unpacked(c) for c in parts["shorter"]])[first]
        below = np.concatenate([np.repeat(unpacked(t), f) for t, f in zip(parts["shorter_totals"], followers)])[first]
        p = np.where(counts > 0, lower.discounted(shorter) / np.maximum(below, 1), 0.0)
        owed = np.bincount(inside, p, len(of))
    rows, entry, place = [], 0, np.searchsorted(of, np.concatenate(contexts))
    context_at = 0
    for run, f in zip(parts["run"], followers):
        mine, entry = counts[at[entry : entry + f.sum()]], entry + int(f.sum())
        own, context_at = place[context_at : context_at + len(f)], context_at + len(f)
        unseen = np.add.reduceat(mine == 0, np.cumsum(f) - f) > 0 if order > 1 else np.zeros(len(f), bool)
        open_ = own[unseen & (total[own] > 0)]
        rows.append(
            {
                "kind": "answer", "run": run, "bucket": int(parts["bucket"].iloc[0]), "counts": packed(mine),
                "totals": packed(total[own]), "open": np.packbits(unseen & (total[own] > 0)).tobytes(),
                "classes": packed(classes[:, open_].ravel()), "owed": owed[open_].tobytes(),
            }
        )
    rows.append(
        {"kind": "classes", "n": int(counts.sum()), "distinct": int((counts > 0).sum()), "classes": packed(np.array(_classes(counts)))}
    )
    if keep:
        held = np.flatnonzero(counts > 0)
        held = held[np.argsort(context[first][held], kind="stable")]
        c, c_end = _cuts(context[first][held])
        zero = np.zeros(len(held), np.int64)
        rows.append(
            {
                "kind": "gram", "bucket": int(parts["bucket"].iloc[0]), "contexts": context[first][held][c].tobytes(),
                "followers": packed(c_end - c), "words": word[first][held].tobytes(), "counts": packed(counts[held]),
                "shorter": packed(shorter[held] if lower is not None else zero),
                "shorter_totals": packed((below[held] if lower is not None else zero)[c]),
            }
        )
    often = gram[times >= _FREQUENT]
    if len(often):
        rows.append({"kind": "frequent", "contexts": often.tobytes()})
    parted = np.flatnonzero(_is_in(of, frequent))
    if order > 1 and len(parted):
        rows.append(
            {
                "kind": "parted", "contexts": of[parted].tobytes(), "totals": packed(total[parted]),
                "classes": packed(classes[:, parted].ravel()), "owed": owed[parted].tobytes(),
            }
        )
    made = pd.DataFrame(rows).reindex(columns=[c.split()[0] for c in _COUNTED.split(", ")])
    made[["run", "bucket", "n", "distinct"]] = made[["run", "bucket", "n", "distinct"]].astype("Int64")
    return made.astype({c: object for c in _BINARY}).where(made.notna(), None)


class _Answers:
    """Counts, totals and weights of the n-grams at each token of a run."""

    def __init__(self, run: Run, rows: pd.DataFrame, levels: Sequence[Level], buckets: int):
        self.levels, self._counts, self._totals, self._weights = levels, {}, {}, {}
        for order, own in rows.groupby("level"):
            before = levels[order - 2].frequent if order > 1 else EMPTY[:0]
            e = Entries.of(run, order, before, buckets)
            starts, ends = _cuts(e.bucket)
            by_bucket = own.set_index("bucket")
            counts, totals = np.zeros(len(e.first), np.int64), np.zeros(len(e.first), np.int64)
            weights = np.zeros(len(e.first))
            freed = levels[order - 1].freed()
            for s, end in zip(starts, ends):
                row = by_bucket.loc[int(e.bucket[s])]
                counts[s:end] = unpacked(row.counts)
                c, c_end = _cuts(e.context[s:end])
                total = unpacked(row.totals)
                weight = np.zeros(len(c))
                open_ = np.unpackbits(np.frombuffer(row.open, np.uint8), count=len(c)).astype(bool)
                if open_.any():
                    free = freed @ unpacked(row.classes).reshape(TOP + 1, -1)
                    weight[open_] = _log_weight(free, total[open_], np.frombuffer(row.owed))
                totals[s:end], weights[s:end] = np.repeat(total, c_end - c), np.repeat(weight, c_end - c)
            if order > 1:
                for context, (total, classes, owed) in levels[order - 1].parted.items():
                    here = e.context == _U(context)
                    if here.any() and total:
                        totals[here] = total
                        weights[here] = _log_weight(freed @ classes, np.array([total]), np.array([owed]))[0]
            self._counts[order], self._totals[order] = counts[e.of_token], totals[e.of_token]
            self._weights[order] = weights[e.of_token]

    def counts(self, order: int) -> np.ndarray:
        return self._counts[order]

    def totals(self, order: int) -> np.ndarray:
        if order == 1:
            return np.full(len(self._counts[1]), self.levels[0].tokens)
        return self._totals[order]

    def log10(self, order: int) -> np.ndarray:
        """Log10 of the probability of each token: by its count, or by the weight and a shorter context."""
        first = self.levels[0]
        unknown = 1.0 if not first.tokens else (first.freed() @ np.array([*first.seen[:TOP], first.seen[-1]])) / first.tokens
        c = self._counts[1]
        found = np.log10(np.where(c > 0, first.discounted(c) / max(1, first.tokens), unknown))
        for k in range(2, order + 1):
            c, total = self._counts[k], np.maximum(self._totals[k], 1)
            own = np.log10(np.maximum(self.levels[k - 1].discounted(c), 1e-300) / total)
            found = np.where(c > 0, own, self._weights[k] + found)
        return found


def _log_weight(freed: np.ndarray, total: np.ndarray, owed: np.ndarray) -> np.ndarray:
    """Log10 of what a context's discounts leave, shared out over what its followers leave one order below."""
    return np.log10(freed / total / (1 - owed))


def _run_table(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Runs of texts as vocabulary and tokens, in files bucketed by run, so that no run is shuffled."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll, blank = Rolling(3), _blanks()
        for number, rows in runs(batches, "text", _RUN_CHARS):
            own = [word_hashes(t, roll, blank) for t in rows["text"]]
            words, at, n = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
            by = np.argsort(-n, kind="stable")  # frequent words get small numbers
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            row = (number, list(rows["doc"]), packed(np.array([len(w) for w in own])), words[by].tobytes(), _planes(place[at]))
            yield pd.DataFrame([row], columns=["run", "docs", "lengths", "words", "tokens"])

    doc = docs.schema["doc"].dataType.simpleString()
    made = docs.mapInPandas(gather, f"run long, docs array<{doc}>, lengths binary, words binary, tokens binary")
    return kept_runs(made, n_buckets, "katz")


def _ask_first(buckets: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def ask(own: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples(index=False))
        return _asked(Run.of(row), row.run, 1, None, [], buckets)

    return ask


def _ask(order: int, levels: tuple[Level, ...], buckets: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def ask(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples(index=False))
        run = Run.of(row)
        return _asked(run, row.run, order, _Answers(run, rows, levels, buckets), levels, buckets)

    return ask


def _count(order: int, levels: tuple[Level, ...], keep: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def count(parts: pd.DataFrame) -> pd.DataFrame:
        lower = levels[-1] if levels else None
        return _counted(parts, order, lower.frequent if lower else EMPTY[:0], lower, keep).assign(level=order)

    return count


def _level(counted: DataFrame, order: int) -> Level:
    """What the buckets of one order have found, as numbers for the driver: some for each bucket, and a few
    for each frequent context, of which there are at most ``tokens / 2 ** 18``."""
    seen, tokens, words = np.zeros(TOP + 2, np.int64), 0, 0
    frequent, parted = [EMPTY[:0]], {}
    for row in counted.where("kind IN ('classes', 'frequent', 'parted')").select("kind", "n", "distinct", "contexts", "totals", "classes", "owed").toLocalIterator():
        if row.kind == "classes":
            seen += unpacked(row["classes"])
            tokens, words = tokens + row.n, words + row.distinct
        elif row.kind == "frequent":
            frequent.append(np.frombuffer(row.contexts, _U))
        else:
            classes = unpacked(row["classes"]).reshape(TOP + 1, -1).T
            for c, t, m, p in zip(np.frombuffer(row.contexts, _U).tolist(), unpacked(row.totals).tolist(), classes, np.frombuffer(row.owed)):
                old = parted.get(c, (0, np.zeros(TOP + 1, np.int64), 0.0))
                parted[c] = (old[0] + t, old[1] + m, old[2] + float(p))
    contexts = np.unique(np.concatenate([*frequent, _all_start(order + 1)]))
    return Level(tuple(seen.tolist()), tokens, words, contexts, parted)


def _source(docs: DataFrame, train: Column, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, int]:
    """Documents, their runs, and the bytes of all texts."""
    row = F.struct(F.col(doc_id).alias("doc"), F.coalesce(train, F.lit(False)).alias("train"))
    source = docs.select(row.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    volume = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return source, _run_table(source, max(8, -(-volume // _RUN_CHARS))), volume


def _orders(
    run_table: DataFrame, order: int, buckets: int, path: str, keep: bool = False, model: KatzModel | None = None
) -> tuple[list[Level], DataFrame]:
    """Levels and answers for the runs, order after order; by a kept model if there is one."""
    spark, levels, answers = run_table.sparkSession, list(model.levels) if model else [], None
    shape = f"level int, {_COUNTED}"
    for k in range(1, order + 1):
        known = tuple(levels[: k - 1])
        if k == 1:
            # By run, though each has one row: a batch of rows could hold many runs.
            asked = run_table.groupBy("run").applyInPandas(_ask_first(buckets), _PART)
        else:
            both = run_table.groupBy("run").cogroup(answers.groupBy("of_run"))
            asked = both.applyInPandas(_ask(k, known, buckets), _PART)
        if model:
            asked = asked.unionByName(model.grams(k))
        grouped = by_bucket(asked, buckets).applyInPandas(_count(k, known, keep), shape)
        grouped.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/order-{k}")
        counted = spark.read.schema(shape).parquet(f"{path}/order-{k}")
        if not model:
            levels.append(_level(counted, k))
        new = counted.where(f"kind = 'answer' AND run != {_MODEL}").select(
            F.col("run").alias("of_run"), "level", "bucket", "counts", "totals", "open", "classes", "owed"
        )
        answers = new if answers is None else answers.unionByName(new)
    return levels, answers


def _scored(run_table: DataFrame, answers: DataFrame, levels: Sequence[Level], order: int, buckets: int, doc_id: str) -> DataFrame:
    known = tuple(levels)

    def score(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        row = next(own.itertuples(index=False))
        run = Run.of(row)
        got = _Answers(run, rows, known, buckets)
        c, first = got.counts(1), known[0]
        base = np.log10((c + 1) / (first.tokens + first.words + 1))
        starts = run.starts
        return pd.DataFrame(
            {
                "doc": list(row.docs),
                "n_tokens": np.diff(np.r_[starts, len(run.tokens)]),
                "n_known": np.add.reduceat((c > 0).astype(np.int64), starts),
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(got.log10(order), starts),
            }
        )

    both = run_table.groupBy("run").cogroup(answers.groupBy("of_run"))
    doc_type = run_table.schema["docs"].dataType.elementType.simpleString()
    shape = f"doc {doc_type}, n_tokens long, n_known long, base_score double, score double"
    scored = both.applyInPandas(score, shape)
    return scored.select(
        F.col("doc.doc").alias(doc_id),
        F.col("doc.train").alias("train"),
        "n_tokens",
        "n_known",
        F.lit(levels[0].tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def score_texts(
    docs: DataFrame,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = 2,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """Per row: ``doc_id, train, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of the text, parted by blanks and with A-Z lower-cased, and its end; a null text
    is empty and has its end only. The model of n-grams up to ``order`` learns from the rows where ``train``
    is true, null counting as false; ``score`` is its log10 probability of the text, ``base_score`` that of
    words with one added to each count. A word the model does not know has the probability of all unknown
    ones together. Without any training rows all words are unknown and both scores are 0. Equal texts have
    equal scores; an empty table gives no rows; other columns are not read. A task holds a run of 8 MB of
    text or a single longer one, or a bucket of about ``bucket_bytes`` of text, whatever the counts are.

    Learning and scoring in one go: counts meet their texts as they are summed and are not kept. ``fit_katz``
    keeps them, for other texts.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    _, run_table, volume = _source(docs, train, doc_id, text)
    buckets = max(8, -(-volume // bucket_bytes))
    levels, answers = _orders(run_table, order, buckets, new_folder(docs.sparkSession, "katz"))
    return _scored(run_table, answers, levels, order, buckets, doc_id)


@dataclass(frozen=True)
class KatzModel:
    """A kept model: tables of n-grams by order and bucket, and what is known of each order."""

    spark: SparkSession
    path: str
    order: int
    buckets: int
    levels: tuple[Level, ...]

    def grams(self, order: int) -> DataFrame:
        """N-grams of an order with their counts, as parts of a run of their own."""
        held = self.spark.read.schema(f"level int, {_COUNTED}").parquet(f"{self.path}/order-{order}").where("kind = 'gram'")
        names = [c.split()[0] for c in _PART.split(", ")]
        given = {"run": F.lit(_MODEL).cast("bigint"), "times": F.col("counts")}
        return held.select(*[given.get(n, F.col(n)).alias(n) for n in names])

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """As ``score_texts``, for texts that the model need not have seen; nothing is learned from them."""
        _, run_table, _ = _source(docs, F.lit(False), doc_id, text)
        folder = new_folder(self.spark, "katz-asked")
        levels, answers = _orders(run_table, self.order, self.buckets, folder, model=self)
        return _scored(run_table, answers, levels, self.order, self.buckets, doc_id)


_LEVEL = (
    "level int, buckets long, seen array<long>, tokens long, words long, frequent binary, contexts binary,"
    " totals binary, classes binary, owed binary"
)


def fit_katz(
    docs: DataFrame, path: str, train: Column | None = None, text: str = "text", order: int = 2, bucket_bytes: int = 16 << 20
) -> KatzModel:
    """Learn from all rows of ``docs``, or those where ``train`` is true, and keep the model at ``path``.

    Counts lie in a Parquet table for each order, partitioned by kind and in rows by bucket; with them what
    backoff weights are made of: totals, classes of followers and what followers leave one order below.
    """
    spark = docs.sparkSession
    _, run_table, volume = _source(docs.withColumn("_no", F.lit(0)), F.lit(True) if train is None else train, "_no", text)
    buckets = max(8, -(-volume // bucket_bytes))
    levels, _ = _orders(run_table, order, buckets, path, keep=True)
    rows = []
    for k, level in enumerate(levels, 1):
        parted = level.parted
        classes = np.array([m for _, m, _ in parted.values()], np.int64).reshape(-1, TOP + 1)
        rows.append(
            (
                k, buckets, list(level.seen), level.tokens, level.words, bytearray(level.frequent.tobytes()),
                bytearray(np.array(list(parted), _U).tobytes()), bytearray(packed(np.array([t for t, _, _ in parted.values()], np.int64))),
                bytearray(packed(classes.ravel())), bytearray(np.array([p for _, _, p in parted.values()], float).tobytes()),
            )
        )
    spark.createDataFrame(rows, _LEVEL).coalesce(1).write.parquet(f"{path}/levels")
    return read_katz(spark, path)


def read_katz(spark: SparkSession, path: str) -> KatzModel:
    """The model that ``fit_katz`` has kept at ``path``."""
    rows = spark.read.schema(_LEVEL).parquet(f"{path}/levels").orderBy("level").collect()  # a row for each order
    levels = []
    for r in rows:
        classes = unpacked(bytes(r["classes"])).reshape(-1, TOP + 1)
        owed, totals = np.frombuffer(bytes(r.owed)), unpacked(bytes(r.totals))
        contexts = np.frombuffer(bytes(r.contexts), _U)
        parted = {c: (int(t), m, float(p)) for c, t, m, p in zip(contexts.tolist(), totals, classes, owed)}
        levels.append(Level(tuple(r.seen), r.tokens, r.words, np.frombuffer(bytes(r.frequent), _U), parted))
    return KatzModel(spark, path, len(levels), rows[0].buckets, tuple(levels))
