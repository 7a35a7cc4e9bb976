"""Chat formatting, in DataFrame functions only.

A template names the marks, the roles whose text is trained on, and a finite-state
machine over roles. Every conversation is formatted; the machine says whether its
turn order is allowed and where it first breaks.

A control string (any mark, and any further reserved string) inside a text is
broken by a backslash after its first character, and every backslash is doubled;
so no control string is left inside a text, and undoing it is exact.

Null role or text: empty. Rows of one conversation are ordered by turn (null
first), equal turns by role and text. Null conv_id: one conversation. Repeated rows
are turns of their own. Other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    turn: str = "<|turn|>"
    body: str = "<|text|>"
    end: str = "<|end|>"
    trained: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant", "user")
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.body, self.end, *self.reserved)

    def __post_init__(self):
        if any("\\" in c or len(c) < 2 for c in self.controls):
            raise ValueError("control strings have two characters or more and no backslash")
        for c in self.controls:
            if any(c[0] in other[1:] and c != other and c in other for other in self.controls):
                raise ValueError(f"{c} lies inside another control string")


def escape(text: Column, template: Template) -> Column:
    """A backslash after each backslash and after the first character of each control string."""
    tails: dict[str, list[str]] = {}
    for c in template.controls:
        tails.setdefault(c[0], []).append(re.escape(c[1:]))
    heads = [rf"{re.escape(first)}(?=(?:{'|'.join(rest)}))" for first, rest in tails.items()]
    return F.regexp_replace(text, r"(\\|" + "|".join(heads) + ")", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, segments, formatted, valid, broken_at.

    ``segments``: array of (role, text, loss), the pieces of ``formatted`` in order:
    marks (role null) and escaped texts, ``loss`` true where the text is trained
    on. ``broken_at``: number of the first turn that the machine does not allow, or
    null; ``valid``: no such turn and the last state is final.
    """
    t = template or Template()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    ordered = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )
    allowed = F.create_map(*[F.lit(x) for pair in ((f"{a}>{b}", True) for a, bs in t.moves.items() for b in bs) for x in pair])
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("broken"))

    def step(s: Column, x: Column) -> Column:
        known = F.coalesce(F.element_at(allowed, F.concat(s["state"], F.lit(">"), x["role"])), F.lit(False))
        return F.struct(
            x["role"].alias("state"), (s["n"] + 1).alias("n"),
            F.coalesce(s["broken"], F.when(~known, s["n"])).alias("broken"),
        )

    def piece(role: Column, text: Column, loss: Column) -> Column:
        return F.struct(role.alias("role"), text.alias("text"), loss.alias("loss"))

    def pieces(x: Column) -> Column:
        mark, off = F.lit(None).cast("string"), F.lit(False)
        opening = F.concat(F.lit(t.turn), escape(x["role"], t), F.lit(t.body))
        return F.array(
            piece(mark, opening, off), piece(x["role"], escape(x["text"], t), x["role"].isin(*t.trained)), piece(mark, F.lit(t.end), off)
        )

    run = F.aggregate("turns", start, step)
    return (
        ordered.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"), run.alias("run"))
        .select(
            "conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"),
            (F.col("run.broken").isNull() & F.col("run.state").isin(*t.final)).alias("valid"), F.col("run.broken").alias("broken_at"),
        )
    )


def read_formatted(formatted: Column, template: Template | None = None) -> Column:
    """The turns of a formatted conversation: array of (role, text), texts as they were."""
    t = template or Template()
    parts = F.split(formatted, re.escape(t.turn), -1)
    return F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda x: F.struct(
            unescape(F.substring_index(x, t.body, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(x, t.body, -1), t.end, 1)).alias("text"),
        ),
    )


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
