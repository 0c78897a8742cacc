"""Repairing the order of speakers in conversations, by the cheapest edits.

Rows are deduced away one by one, as in Knuth's generalisation of shortest paths to weighted deductions. An item
(rows read, state of the grammar) says how the rows so far can be repaired; keeping, giving another role, deleting and
inserting derive further items. The value of an item is the pair (cost, audit), where the audit has one letter per
edit, and pairs are compared in that order. Each deduction adds to the cost and appends to the audit, so a derived
value is above that of its premise, and two audits of one item and cost read as many rows, so neither begins the other
and appending keeps their order: the functions are superior. The agenda therefore pops every item with its best
value first, and stops as soon as the goal item is popped.

A conversation streams through one task in sections of ``SECTION`` rows. The agenda of a section starts from the
items that ended the last one, each with its audit and the digest of its repaired text so far, and runs until all
items at the section's end are final; only the last section has the goal. So a conversation of any length holds one
section and as many digests as the grammar has states. That it passes one task cannot be helped, since the digest of
the repaired text is sequential; a section, not the conversation, bounds the memory.

Rows follow by turn, those without one first, then by role and text, so equal turns have one order. A null role or
text is one space, and so is a null conversation or turn in the text that decides about damage. Rows with a null
conversation form one conversation of their own. Repeated rows are duplicates. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SECTION = 256
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: What edits cost, and what a truncated row costs unless it is deleted.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: Faults of a row; a blank or a duplicate one must be deleted.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

#: (s?(ua)+)? by first letters of roles: what may follow in each state, and where it leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FINAL = (START, ASSISTANT)
#: Roles that a row may be given or that may be put in.
ROLES = ("assistant", "user")
_SPACES = "[ \\t-\\r]"


@dataclass
class Item:
    """A final item between two sections: what it has cost, and the repaired text so far."""

    cost: int = 0
    audit: str = ""
    digest: object = field(default_factory=hashlib.sha256)
    begun: bool = False

    def after(self, cost: int, audit: str, lines: list[str]) -> Item:
        digest = self.digest.copy()
        for i, line in enumerate(lines):
            digest.update((("\n" if self.begun or i else "") + line).encode())
        return Item(cost, audit, digest, self.begun or bool(lines))


def deduced(rows: list[tuple[str, str, int]], start: dict[int, Item], last: bool) -> dict[int, Item]:
    """The best items at the end of the rows (role, text, fault), by state; just the goal's if they are the last."""
    agenda = [(item.cost, item.audit, 0, state, -state, None) for state, item in start.items()]
    heapq.heapify(agenda)
    pushed = count()  # so that what an item came from is never compared
    final: dict[tuple[int, int], tuple] = {}  # how each popped item came about
    ends: dict[int, tuple[int, str]] = {}
    n = len(rows)

    def push(cost: int, audit: str, at: int, state: int, why: tuple) -> None:
        if (at, state) not in final:
            heapq.heappush(agenda, (cost, audit, at, state, next(pushed), why))

    while agenda:
        cost, audit, at, state, _, why = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final[at, state] = why
        if at == n:
            ends[state] = (cost, audit)
            if last and state in FINAL:
                ends = {state: (cost, audit)}
                break
        here, steps = (at, state), STEPS[state]
        for role in ROLES:
            if role[0] in steps:
                push(cost + INSERT_COST, audit + INSERT, at, steps[role[0]], (here, role + ":"))
        if at == n:
            continue
        role, text, fault = rows[at]
        push(cost + DELETE_COST, audit + DELETE, at + 1, state, (here, None))
        if fault in (BLANK, DUPLICATE):
            continue
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        if role[:1] in steps:
            push(cost + extra, audit + KEEP, at + 1, steps[role[:1]], (here, f"{role}:{text}"))
        for other in ROLES:
            if other[0] in steps:
                push(cost + extra + REROLE_COST, audit + REROLE, at + 1, steps[other[0]], (here, f"{other}:{text}"))
    out = {}
    for state, (cost, audit) in ends.items():
        lines, item = [], (n, state)
        while final[item] is not None:
            item, line = final[item]
            if line is not None:
                lines.append(line)
        out[state] = start[item[1]].after(cost, audit, lines[::-1])
    return out


class Conversation:
    """One conversation, row by row in its order."""

    def __init__(self) -> None:
        self.items, self.rows = {START: Item()}, []
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.turns, self.first, self.turn = 0, None, None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if len(self.rows) >= SECTION:
            self.items, self.rows = deduced(self.rows, self.items, last=False), []
        self.rows.append((role, text, fault))
        self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.first, self.turn = turn if self.first is None else self.first, turn

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
        (best,) = deduced(self.rows, self.items, last=True).values()
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return gaps, *self.faults[1:], self.illegal, best.cost, best.audit, best.digest.hexdigest()


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, there) with deterministic damage; a dropped row stays, as one that is not there."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    key = F.concat(blank(F.col(conv)), F.lit(":"), blank(F.col(turn)))
    plain = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank(F.col(role)).alias("role"), blank(F.col(text)).alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("kind"),
    )
    kind = F.col("kind")
    changed = plain.select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind != 0).alias("there"), F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return changed.withColumn("times", F.explode(F.array_repeat("times", F.col("times")))).drop("times")


def with_faults(rows: DataFrame) -> DataFrame:
    """The first fault of each row of (conv, turn, role, text, there), all rows of a conversation in one partition."""
    same = Window.partitionBy("conv", "role", "text", "there").orderBy(F.asc_nulls_first("turn"))
    ends: Column = F.col("text").rlike(f"[.!?]{_SPACES}*\\z")
    counted = rows.repartition("conv").withColumn("nth", F.row_number().over(same))
    fault = F.when(~F.col("text").rlike("[^ \\t-\\r]"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(~ends, TRUNCATED)
    return counted.withColumn("fault", fault.otherwise(NONE))


def repaired(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of the rows (conv, turn, role, text, there): what was wrong and how it was mended."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = (
        f"`{conv}` {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    ordered = with_faults(rows).select("conv", "turn", "role", "text", "there", "fault", "nth").sortWithinPartitions(
        "conv", F.asc_nulls_first("turn"), "role", "text", "nth"
    ).drop("nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, done = None, None, []

        def flushed(batch_schema: pa.Schema) -> pa.RecordBatch:
            kinds = [batch_schema.field("conv").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = [conv, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

        seen = None
        for batch in batches:
            seen = batch.schema
            for i in range(0, batch.num_rows, 1000):
                for own, turn, role, text, there, fault in zip(*[c.to_pylist() for c in batch.slice(i, 1000).columns]):
                    if now is None or own != key:
                        if now is not None:
                            done.append((key, *now.result()))
                        key, now = own, Conversation()
                    if there:
                        now.add(turn, role, text, fault)
            if done:
                yield flushed(seen)
                done.clear()
        if now is not None:
            done.append((key, *now.result()))
            yield flushed(seen)

    return ordered.mapInArrow(run, schema)
