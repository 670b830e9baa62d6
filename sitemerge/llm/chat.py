"""Chat formatting: a state machine over roles and a declarative template.

Only DataFrame functions run here.  ``format_chats`` gathers the rows of a
conversation, walks the state machine over their roles and emits *segments*
(text, loss flag); the formatted text is their concatenation.  ``read_back``
recovers roles and texts from the formatted text alone.

Escaping.  Inside a role or text, an escape character follows every escape
character and the first character of every control string, so no control
string of the template survives in user text.  Because no control string
holds the escape character, the inverse is unambiguous.

Defined results: a null role or text counts as empty; a null ``conv_id`` is a
conversation of its own; rows are ordered by turn, then role, then text, nulls
first, and repeated rows stay repeated; a role the machine doesn't know, or a
turn it doesn't expect, is formatted all the same and counted in
``n_violations``; an empty table gives an empty table; other columns are
ignored.  One conversation is one output row, so a conversation must fit in
a row (2 GB); its rows are combined before the shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JAVA_META = re.compile(r"([\\\[\](){}.*+?^$|/<>#&~-])")


def _quote(text: str) -> str:
    return JAVA_META.sub(r"\\\1", text)


@dataclass(frozen=True)
class ChatTemplate:
    """``turn`` role ``body`` text ``end`` per turn; the text of ``loss_roles``
    carries loss.  ``transitions`` maps state -> {role: next state}; a role
    without a transition is a violation and moves to ``resync[role]``."""

    turn: str = "[INST]"
    body: str = "[/INST]"
    end: str = "</s>"
    escape: str = "\\"
    reserved: tuple = ("<s>", "<|endoftext|>")
    loss_roles: tuple = ("assistant",)
    start: str = "start"
    accepting: tuple = ("answered",)
    transitions: dict = field(default_factory=lambda: {
        "start": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    resync: dict = field(default_factory=lambda: {
        "system": "briefed", "user": "asked", "assistant": "answered"})

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or self.escape in c:
                raise ValueError(f"control string {c!r}: two characters at least, no escape")
            if any(c.endswith(c[:i]) for i in range(1, len(c))):
                raise ValueError(f"control string {c!r} overlaps itself")

    @property
    def controls(self) -> tuple:
        return (self.turn, self.body, self.end, *self.reserved)

    def escaped(self, text: Column) -> Column:
        firsts = "|".join(f"{_quote(c[0])}(?={_quote(c[1:])})" for c in self.controls)
        pattern = f"{_quote(self.escape)}|{firsts}"
        return F.regexp_replace(text, F.lit(pattern), F.lit("$0" + _quote(self.escape)))

    def unescaped(self, text: Column) -> Column:
        e = _quote(self.escape)
        firsts = "".join(sorted({_quote(c[0]) for c in self.controls}))
        pattern = f"({e}){e}|([{firsts}]){e}(?!{e})"
        return F.regexp_replace(text, F.lit(pattern), F.lit("$1$2"))


def _steps(template: ChatTemplate, turns: Column) -> Column:
    """Walk the machine: struct(state, bad, first_bad, i) after the last turn."""
    sep = "\x00"
    pairs = [F.lit(x) for s, to in template.transitions.items()
             for r, n in to.items() for x in (f"{s}{sep}{r}", n)]
    table = F.create_map(*pairs)
    resync = F.create_map(*[F.lit(x) for kv in template.resync.items() for x in kv])

    def step(acc, t):
        to = F.try_element_at(table, F.concat(acc["state"], F.lit(sep), t["role"]))
        bad = to.isNull()
        return F.struct(
            F.coalesce(to, F.try_element_at(resync, t["role"]), acc["state"]).alias("state"),
            (acc["bad"] + bad.cast("int")).alias("bad"),
            F.when(bad & (acc["first_bad"] < 0), acc["i"]).otherwise(acc["first_bad"]).alias("first_bad"),
            (acc["i"] + 1).alias("i"),
        )

    init = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("bad"),
                    F.lit(-1).alias("first_bad"), F.lit(0).alias("i"))
    return F.aggregate(turns, init, step)


def format_chats(rows: DataFrame, template: ChatTemplate | None = None, conv: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text, loss),
    ``formatted``, ``n_violations``, ``first_violation`` (turn index, else
    null) and ``complete`` (no violation and an accepting end state)."""
    tp = template or ChatTemplate()
    turns = (
        rows.select(F.col(conv).alias("conv_id"), F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )

    def segments(t):
        header = F.concat(F.lit(tp.turn), tp.escaped(t["role"]), F.lit(tp.body))
        return F.array(
            F.struct(header.alias("text"), F.lit(False).alias("loss")),
            F.struct(tp.escaped(t["text"]).alias("text"),
                     t["role"].isin(*tp.loss_roles).alias("loss")),
            F.struct(F.lit(tp.end).alias("text"), F.lit(False).alias("loss")),
        )

    walked = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        _steps(tp, F.col("turns")).alias("fsm"),
    )
    return walked.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("fsm.bad").cast("long").alias("n_violations"),
        F.when(F.col("fsm.first_bad") >= 0, F.col("fsm.first_bad")).alias("first_violation"),
        ((F.col("fsm.bad") == 0) & F.col("fsm.state").isin(*tp.accepting)).alias("complete"),
    )


def read_back(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """array<struct<role, text>> recovered from a formatted text."""
    tp = template or ChatTemplate()
    pieces = F.split(formatted, _quote(tp.end), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(piece):
        halves = F.split(piece, _quote(tp.body), 2)
        return F.struct(
            tp.unescaped(F.substring(halves[0], len(tp.turn) + 1, 2**31 - 1)).alias("role"),
            tp.unescaped(halves[1]).alias("text"))

    return F.transform(pieces, parse)


def loss_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped segment by segment."""
    tp = template or ChatTemplate()
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: tp.unescaped(s["text"])), "")
