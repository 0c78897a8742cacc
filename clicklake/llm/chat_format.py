"""Chat formatting: a state machine over roles and segments from a declarative template.

A conversation becomes a list of segments, each with a flag that says whether it counts for the loss. Texts are escaped
so that no control string of the template can occur in them, and :func:`parsed` reads roles and texts back.

Turns are ordered by turn, then role, then text; null texts and roles count as empty. A conversation is one value, as
formatted text has to be; conversations are independent of each other. The machine's state is kept with every segment:
from the first turn that comes out of order on it is ``invalid``, which ``valid`` and ``first_bad`` report, and the
conversation is formatted all the same. What counts for the loss is told by spans of the formatted text.

Rows without a conversation id form one conversation of their own; repeated rows are turns of their own; other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import filled


@dataclass(frozen=True)
class Template:
    """What stands around a turn of each role, and around any other role (with its name between the first two)."""

    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s>", "</s>"),
    })
    other: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>", "<<END>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    # Control strings all begin with one of these; a backslash after each keeps texts free of them.
    openers: tuple[str, ...] = ("<", "[")
    # state -> role -> next state; a role is a state's name here.
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })


def escaped(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for opener in template.openers:
        out = F.replace(out, F.lit(opener), F.lit(opener + "\\"))
    return out


def unescaped(text: Column, template: Template) -> Column:
    for opener in template.openers:
        text = F.replace(text, F.lit(opener + "\\"), F.lit(opener))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def _per_role(role: Column, known: dict[str, str], other: Column) -> Column:
    out = other
    for name, value in known.items():
        out = F.when(role == name, F.lit(value)).otherwise(out)
    return out


def accepted(turns: Column, template: Template) -> Column:
    """How many turns the machine takes before one comes out of order."""
    steps = {f"{state} {role}": role for state, roles in template.order.items() for role in roles}

    def step(now, turn):
        state = _per_role(F.concat_ws(" ", now["state"], turn["role"]), steps, F.lit("invalid"))
        return F.struct(state.alias("state"), (now["n"] + (state != "invalid").cast("int")).alias("n"))
    return F.aggregate(turns, F.struct(F.lit("start").alias("state"), F.lit(0).alias("n")), step)["n"]


def segments(turns: Column, taken: Column, template: Template) -> Column:
    """Per turn its opening, its escaped text and its closing, as structs (text, loss, state). ``taken`` turns are in order."""
    no = F.lit(False)

    def one(turn, i):
        role = turn["role"]
        state = F.when(i < taken, role).otherwise("invalid").alias("state")
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"), state)
        name = F.concat(F.lit(template.other[0]), escaped(role, template), F.lit(template.other[1]))
        opening = _per_role(role, {r: t[0] for r, t in template.turns.items()}, name)
        closing = _per_role(role, {r: t[1] for r, t in template.turns.items()}, F.lit(template.other[2]))
        return F.array(part(opening, no), part(escaped(turn["text"], template), role.isin(*template.loss_roles)), part(closing, no))

    return F.flatten(F.transform(turns, one))


def loss_spans(pieces: Column) -> Column:
    """Where in the formatted text the segments under the loss stand, as structs (start, length)."""
    def step(now, piece):
        length = F.length(piece["text"])
        here = F.array(F.struct(now["at"].alias("start"), length.alias("length")))
        spans = F.when(piece["loss"], F.concat(now["spans"], here)).otherwise(now["spans"])
        return F.struct((now["at"] + length).alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]


def formatted(rows: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: id, segments, whether the order of turns is valid or else which turn is the first bad one
    (from 0), the whole text, and the spans of it that count for the loss."""
    one = F.struct(F.col(turn).alias("turn"), filled(F.col(role)).alias("role"), filled(F.col(text)).alias("text"))
    grouped = rows.groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    taken = grouped.withColumn("taken", accepted(F.col("turns"), template))
    bad = F.when(F.col("taken") < F.size("turns"), F.col("taken"))
    pieces = taken.select(conv, segments(F.col("turns"), F.col("taken"), template).alias("segments"), bad.alias("first_bad"))
    return pieces.select(
        conv, "segments", F.col("first_bad").isNull().alias("valid"), "first_bad",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), loss_spans(F.col("segments")).alias("loss_spans"),
    )


def parsed(text: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text, as structs (role, text)."""
    quoted = [f"{re.escape(a)}.*?{re.escape(b)}" for a, b in template.turns.values()]
    a, b, c = template.other
    quoted.append(f"{re.escape(a)}.*?{re.escape(b)}.*?{re.escape(c)}")
    found = F.regexp_extract_all(text, F.lit("(?s)" + "|".join(quoted)), F.lit(0))

    def one(turn):
        rest = F.substring(turn, len(a) + 1, F.length(turn) - len(a) - len(c))
        name = F.substring_index(rest, b, 1)
        role, inner = name, F.substring(rest, F.length(name) + len(b) + 1, F.length(rest))
        for known, (opening, closing) in template.turns.items():
            here = F.startswith(turn, F.lit(opening))
            between = F.substring(turn, len(opening) + 1, F.length(turn) - len(opening) - len(closing))
            role, inner = F.when(here, F.lit(known)).otherwise(role), F.when(here, between).otherwise(inner)
        return F.struct(unescaped(role, template).alias("role"), unescaped(inner, template).alias("text"))

    return F.transform(found, one)


def loss_text(text: Column, spans: Column, template: Template = Template()) -> Column:
    """All of a formatted text that counts for the loss, unescaped, with nothing in between."""
    cut = lambda span: unescaped(F.substring(text, span["start"] + 1, span["length"]), template)
    return F.array_join(F.transform(spans, cut), "")
