"""Conversations as training text, by column expressions alone.

The turns of a conversation are collected and sorted, adjacent turns of one role are merged into a block
and the blocks joined. A block is ``start role head text end``; the texts of a merged block are parted by
``part``, so that the turns can be read back. Control strings in roles and texts get a backslash after
their first character (one more if they have some), which can be undone and leaves no control string.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings of a template. ``reserved`` ones do not occur in it but are escaped as well.

    A control string starts with an opener that occurs nowhere else in it: thus no two overlap, and none
    arises where a text meets a control string.
    """

    start: str = "<|turn|>"
    head: str = "<|text|>"
    part: str = "<|part|>"
    end: str = "<|end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    trained_role: str = "assistant"

    def __post_init__(self):
        openers = {s[:1] for s in self.controls}
        for s in self.controls:
            if len(s) < 2 or s[1] == "\\" or openers & set(s[1:]):
                raise ValueError(f"not a control string: {s!r}")
        if len({self.start, self.head, self.part, self.end}) < 4:
            raise ValueError("start, head, part and end must differ")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.head, self.part, self.end, *self.reserved)

    def _rewrite(self, text: Column, found: str, put: str) -> Column:
        for opener in sorted({s[0] for s in self.controls}):
            bodies = "|".join(re.escape(s[1:]) for s in self.controls if s[0] == opener)
            pattern = f"{re.escape(opener)}{found}({bodies})"
            text = F.regexp_replace(text, pattern, f"{opener}{put}$2")
        return text

    def escape(self, text: Column) -> Column:
        return self._rewrite(text, r"(\\*)", r"$1\\")

    def unescape(self, text: Column) -> Column:
        return self._rewrite(text, r"\\(\\*)", "$1")


def _text(part: Column, trained: Column | bool) -> Column:
    flag = trained if isinstance(trained, Column) else F.lit(trained)
    return F.struct(part.alias("text"), flag.alias("trained"))


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conversation``, ``formatted`` and ``segments``.

    ``segments`` are the pieces of ``formatted`` in order, ``(text, trained)``; the trained ones are the
    loss mask and hold the texts of the template's trained role, nothing else. Turns sort by turn, then
    role, then text, a null turn first. A null role or text counts as empty; rows with a null
    conversation form one. Repeated rows are repeated turns. Other columns are not read.

    A conversation is one output row, so its turns meet in one task; the sort and the merge are linear in
    its length.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    said = turns.groupBy(F.col(conversation).alias(conversation)).agg(
        F.sort_array(F.collect_list(one)).alias("said")
    )
    count = F.size("said")

    def role_at(i: Column) -> Column:
        return F.get(F.col("said"), i)["role"]

    first = F.filter(
        F.sequence(F.lit(0), count - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1))
    )
    starts = said.select(conversation, "said", first.alias("starts"))

    def block(at: Column, n: Column) -> Column:
        until = F.coalesce(F.get(F.col("starts"), n + 1), count)
        return F.struct(
            role_at(at).alias("role"),
            F.transform(F.slice("said", at + 1, until - at), lambda t: t["text"]).alias("texts"),
        )

    blocks = starts.select(conversation, F.transform("starts", block).alias("blocks"))

    def pieces(b: Column) -> Column:
        opening = F.concat(F.lit(template.start), template.escape(b["role"]), F.lit(template.head))
        trained = b["role"] == template.trained_role

        def one_text(t: Column, n: Column) -> Column:
            own = _text(template.escape(t), trained)
            between = _text(F.lit(template.part), False)
            return F.when(n == 0, F.array(own)).otherwise(F.array(between, own))

        return F.concat(
            F.array(_text(opening, False)),
            F.flatten(F.transform(b["texts"], one_text)),
            F.array(_text(F.lit(template.end), False)),
        )

    made = blocks.select(conversation, F.flatten(F.transform("blocks", pieces)).alias("segments"))
    return made.select(
        conversation, F.array_join(F.col("segments.text"), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of a formatted text, ``array<struct<role, text>>``."""
    cut = lambda c, mark: F.split(c, re.escape(mark))
    blocks = F.slice(cut(formatted, template.end), 1, F.size(cut(formatted, template.end)) - 1)

    def turns(block: Column) -> Column:
        role, texts = F.get(cut(block, template.head), 0), F.get(cut(block, template.head), 1)
        role = template.unescape(F.substring(role, len(template.start) + 1, 2**31 - 1))
        one = lambda t: F.struct(role.alias("role"), template.unescape(t).alias("text"))
        return F.transform(cut(texts, template.part), one)

    return F.flatten(F.transform(blocks, turns))


def trained_text(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped, nothing between the pieces."""
    own = F.filter(segments, lambda s: s["trained"])
    return F.array_join(F.transform(own, lambda s: template.unescape(s["text"])), "")
