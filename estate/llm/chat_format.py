"""Chat formatting: a finite-state machine over roles and a declarative template.

Native: column expressions only, no Python in the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: state -> role -> next state; a turn without an entry leads to "invalid", which nothing leaves
TRANSITIONS: Mapping[str, Mapping[str, str]] = {
    "start": {"system": "system", "user": "user"},
    "system": {"user": "user"},
    "user": {"assistant": "assistant"},
    "assistant": {"user": "user"},
}


@dataclass(frozen=True)
class Template:
    """``open role header text close``, turn after turn.

    ``learn`` names the roles whose text carries the loss.  ``open`` and ``close`` must start with ``<|``:
    inside texts and roles ``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|``, so no text can hold a
    control string and the escape can be undone.
    """

    open: str = "<|im_start|>"
    header: str = "\n"
    close: str = "<|im_end|>"
    between: str = "\n"
    learn: tuple[str, ...] = ("assistant",)
    transitions: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: TRANSITIONS)
    accepting: tuple[str, ...] = ("user", "assistant")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, n_turns, valid, segments, formatted`` per conversation of ``conv_id, turn, role, text``.

    ``segments`` are ``{text, loss}`` in order and concatenate to ``formatted``; only the escaped texts of the
    ``learn`` roles carry the loss.  ``valid`` says whether the roles follow the machine from "start" to an
    accepting state; invalid conversations are formatted as well.

    Null text and null role are empty (an empty role is never valid); a null ``conv_id`` is a conversation of
    its own; rows are ordered by turn (null first), ties by role and text, and repeated rows stay; an empty
    table gives an empty result; other columns are ignored.
    """
    step = F.create_map(*[F.lit(x) for s, moves in template.transitions.items() for r, to in moves.items() for x in (f"{s}\n{r}", to)])
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    last = F.aggregate(
        "turns", F.lit("start"), lambda state, t: F.coalesce(F.element_at(step, F.concat(state, F.lit("\n"), t["role"])), F.lit("invalid"))
    )

    def parts(t: Column) -> Column:
        head = F.concat(F.lit(template.open), _escape_role(t["role"]), F.lit(template.header))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), t["role"].isin(*template.learn).alias("loss")),
            F.struct(F.lit(template.close + template.between).alias("text"), F.lit(False).alias("loss")),
        )

    out = grouped.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        last.isin(*template.accepting).alias("valid"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns ``{role, text}`` that a formatted conversation holds, unescaped."""
    pieces = F.split(formatted, r"\Q" + template.close + template.between + r"\E")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(template.open) + 1))
        cut = F.locate(template.header, body)
        return F.struct(
            _unescape_role(F.substr(body, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substr(body, cut + len(template.header))).alias("text"),
        )

    return F.transform(turns, turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
