"""Conversations as formatted text with a loss mask.

A template says declaratively which segments a turn consists of, which of them
count for the loss, and which role may follow which. Everything is made of
built-in expressions.

Control strings inside texts are escaped by a backslash after `<` wherever
`<`, any number of backslashes and `|` follow each other. `unescaped` undoes
this exactly, so an escaped text never holds `<|` and nothing is lost.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"
ERROR = "error"


@dataclass(frozen=True)
class Segment:
    """A part of a turn: fixed text, or the turn's `role` or `text`."""

    literal: str | None = None
    field: str | None = None
    loss_roles: tuple[str, ...] = ()


@dataclass(frozen=True)
class Template:
    """Segments of a turn and the machine that says which turns may follow.

    `moves` maps a state and a role to the next state; what is not listed is an
    error, which no turn leaves. A conversation is valid if it ends in one of
    the `final` states. The first literal opens a turn, the last one ends it,
    and the one after the role ends the role.
    """

    segments: tuple[Segment, ...] = (
        Segment(literal="<|im_start|>"),
        Segment(field="role"),
        Segment(literal="\n"),
        Segment(field="text", loss_roles=("assistant",)),
        Segment(literal="<|im_end|>\n"),
    )
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            (START, "system"): "briefed",
            (START, "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    @property
    def opening(self) -> str:
        return self.segments[0].literal

    @property
    def ending(self) -> str:
        return self.segments[-1].literal


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, segments, valid, error_turn) of (conv_id, turn, role, text) rows.

    `segments` are (text, loss) in order; `formatted` is all of them joined.
    `error_turn` is the position from 0 of the first turn that must not stand
    where it stands, null if there is none. Null roles and texts count as
    empty, turns with equal numbers are ordered by role and text, null turns
    come first, and the rows with a null conv_id are one conversation. Other
    columns are ignored. A conversation is one row of the result, so a single
    one has to fit a cell; no other size is bounded.
    """
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                F.col("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        )
    )
    told = rows.groupBy("conv_id").agg(turns.alias("turns"))
    made = F.flatten(F.transform("turns", lambda t: F.array(*_segments(t, template))))
    walked = F.aggregate(
        "turns",
        F.struct(
            F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("error")
        ),
        lambda at, turn: _step(at, turn, template),
    )
    return (
        told.select("conv_id", made.alias("segments"), walked.alias("end"))
        .select(
            "conv_id",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            "segments",
            F.col("end.state").isin(*template.final).alias("valid"),
            F.when(F.col("end.error") >= 0, F.col("end.error")).alias("error_turn"),
        )
    )


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescaped(s["text"])), "")


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The (role, text) turns that a formatted text was made of."""
    separator = template.segments[2].literal
    pieces = F.split(formatted, _quoted(template.opening))
    pieces = F.slice(pieces, 2, F.size(pieces))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, separator, 1)
        before = F.char_length(role) + len(separator)
        inside = F.char_length(piece) - before - len(template.ending)
        return F.struct(
            _plain_role(role).alias("role"),
            unescaped(F.substring(piece, before + 1, inside)).alias("text"),
        )

    return F.transform(pieces, turn)


def _segments(turn: Column, template: Template) -> list[Column]:
    text = {"role": _safe_role(turn["role"]), "text": escaped(turn["text"])}
    return [
        F.struct(
            (F.lit(s.literal) if s.field is None else text[s.field]).alias("text"),
            (turn["role"].isin(*s.loss_roles) if s.loss_roles else F.lit(False)).alias("loss"),
        )
        for s in template.segments
    ]


def _step(at: Column, turn: Column, template: Template) -> Column:
    state = F.lit(ERROR)
    for (before, role), after in template.moves.items():
        fits = (at["state"] == before) & (turn["role"] == role)
        state = F.when(fits, after).otherwise(state)
    failed = (at["error"] < 0) & (state == ERROR)
    return F.struct(
        state.alias("state"),
        (at["at"] + 1).alias("at"),
        F.when(failed, at["at"]).otherwise(at["error"]).alias("error"),
    )


def _safe_role(role: Column) -> Column:
    """A role as one line: line ends are written %0A, and % is written %25."""
    return F.replace(
        F.replace(escaped(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")
    )


def _plain_role(role: Column) -> Column:
    return unescaped(
        F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
    )


def _quoted(literal: str) -> str:
    return r"\Q" + literal + r"\E"
