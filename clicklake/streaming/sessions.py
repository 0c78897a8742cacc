"""Sessions over a stream.

Two operators with state follow each other. The first one combines events into
one fragment per user, cell and page, before the shuffle, so that a user with a
third of the stream is one small row per cell and page and batch; a fragment
goes on once its cell is older than the watermark. The second one folds the
fragments of a user, cell after cell, into the session that is open: its number,
its bounds and which of its pages were seen once or more often. A session is
reported when a cell begins too late for it, or by a timer once the watermark
has passed everything that could extend it. Neither the stream nor a report
looks back at what was reported before, and the store keeps the pages of a
session as entries of their own, so a batch costs what the batch brings.

Fragments may also be appended to a table, which the batch operator turns into
sessions like events (``start_fragments``, ``streamed_sessions``).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from clicklake.functions.times import MICROSECOND
from clicklake.operators.sessions import (
    CELL, cell_width, gap_sessions_from_fragments, sessions_from_fragments,
)
from clicklake.sources.files import setting


def stream_fragments(stream: DataFrame, user: str, ts: str, page: str, gap: timedelta, delay: timedelta) -> DataFrame:
    """Session fragments of a stream, each emitted once its cell is older than the watermark.

    ``ts`` must be a ``timestamp``. Events more than ``delay`` late may be dropped.
    """
    cell = F.window(ts, f"{cell_width(gap) // MICROSECOND} microseconds")
    return (
        stream.withWatermark(ts, f"{delay // MICROSECOND} microseconds")
        .groupBy(user, cell.alias("_window"), page)
        .agg(
            F.count("*").alias("events"),
            F.count(page).alias("views"),
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.min(ts).alias("began"),
        )
        .withColumn(CELL, F.unix_micros(F.col("_window.start")))
        .drop("_window")
    )


def start_fragments(fragments: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the fragments of all data available now to a folder of parquet files."""
    return (
        fragments.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _seen(spark: SparkSession, table: str, gap: timedelta) -> tuple[DataFrame, Column]:
    """The fragments, and the end of their last cell: events before it are all there. Null without fragments."""
    fragments = spark.read.parquet(table)
    last = fragments.agg(F.max(CELL)).first()[0]
    end = None if last is None else last + cell_width(gap) // MICROSECOND
    return fragments, F.timestamp_micros(F.lit(end).cast("long"))


def streamed_sessions(spark: SparkSession, table: str, user: str, page: str, gap: timedelta) -> DataFrame:
    """The closed sessions of all fragments a stream has written so far.

    Sessions that events still to come could extend are left out until they are closed.
    """
    fragments, end = _seen(spark, table, gap)
    return sessions_from_fragments(fragments, user, page, gap, seen_until=end)


def streamed_gap_sessions(spark: SparkSession, table: str, user: str, gap: timedelta) -> DataFrame:
    """The same by the gap rule alone, where sessions end one gap after their last event."""
    fragments, end = _seen(spark, table, gap)
    return gap_sessions_from_fragments(fragments, user, gap).where(F.col("session_end") < end)


# -- sessions in the state of the stream -------------------------------------------

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a closed session is reported as, times as microseconds; the user comes first.
_REPORT = "session_no long, began long, lasts long, last long, events long"


class SessionFold(StatefulProcessor):
    """Fragments of a user into sessions."""

    def __init__(self, gap: int, cell: int) -> None:
        self.gap, self.cell = gap, cell

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", f"{_REPORT}, timer long")
        self.pages = handle.getMapState("pages", "missing boolean, page string", "views long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # One batch closes few cells; their order matters, that of the pages of a cell does not.
        fragments = sorted((tuple(row[c] for c in _FRAGMENT) for row in rows), key=itemgetter(0))
        held = self.open.get()
        now = self._now(held)
        before = now and now["timer"]
        # Every call to the store is a message to the JVM. Pages are looked up once, and only where a batch before left any;
        # those of the session that stays open are written at the end.
        stored, views, written = now is not None, {}, {}
        for _, cell in groupby(fragments, key=itemgetter(0)):
            cell = list(cell)
            first, last = min(f[1] for f in cell), max(f[2] for f in cell)
            if now and first > now["last"] + self.gap:
                yield self._report(key, now)
                if stored:
                    self.pages.clear()
                stored, views, written = False, {}, {}
                now = {"session_no": now["session_no"] + 1} | _nothing(first)
            now = now or {"session_no": held[0] if held else 0} | _nothing(first)
            for _, _, page_last, page, seen, began, events in cell:
                entry = (page is None, page or "")
                if entry not in views:
                    known = self.pages.getValue(entry) if stored else None
                    views[entry] = written[entry] = known[0] if known else 0
                views[entry] = min(2, views[entry] + seen)
                # The end only moves on: a page lasts for a gap from its second view on.
                lasts = page_last if views[entry] == 1 else page_last + self.gap
                now["lasts"], now["began"] = max(now["lasts"], lasts), min(now["began"], began)
                now["events"] += events
            now["last"] = max(now["last"], last)
        for entry, seen in views.items():
            if seen != written[entry]:
                self.pages.updateValue(entry, (seen,))
        # The first end of a cell by which all events that could extend the session are there.
        now["timer"] = ((now["last"] + self.gap) // self.cell + 1) * self.cell // 1000
        if before != now["timer"]:
            if before:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(now["timer"])
        self.open.update(tuple(now[c] for c in _STATE))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._now(self.open.get())
        if now and now["timer"] == expiredTimerInfo.getExpiryTimeInMs():
            # What stays is the number of the next session.
            self.open.update((now["session_no"] + 1, *[None] * (len(_STATE) - 1)))
            self.pages.clear()
            yield self._report(key, now)

    @staticmethod
    def _now(held: tuple | None) -> dict | None:
        return dict(zip(_STATE, held)) if held and held[-1] is not None else None

    def _report(self, key, now: dict) -> Row:
        return Row(**dict(zip(_KEY, key)), **{c: now[c] for c in _STATE[:-1]})

    def close(self) -> None:
        pass


# Missing users are told by a flag: groups of null keys are not kept together.
_KEY = ["no_user", "user_key"]
_FRAGMENT = ["cell", "first", "last", "page", "views", "began", "events"]
_STATE = ["session_no", "began", "lasts", "last", "events", "timer"]


def _nothing(first: int) -> dict:
    return {"began": first, "lasts": first, "last": first, "events": 0}


def session_stream(stream: DataFrame, user: str, ts: str, page: str, gap: timedelta, delay: timedelta) -> DataFrame:
    """The closed sessions of a stream, as a stream of (user, session_no, session_min, session_max, last_ts, events).

    ``ts`` must be a ``timestamp``; events more than ``delay`` late may be dropped. Rows without a user are one user, as in
    the batch operator. The query needs the RocksDB state store (``start_sessions`` sets it).
    """
    micros = lambda c: F.unix_micros(c)
    kind = stream.schema[user].dataType.simpleString()
    cell = F.window(ts, f"{cell_width(gap) // MICROSECOND} microseconds")
    fragments = (
        stream.withWatermark(ts, f"{delay // MICROSECOND} microseconds")
        .groupBy(user, cell.alias("_window"), page)
        .agg(F.count("*").alias("events"), F.count(page).alias("views"), F.min(ts).alias("_first"), F.max(ts).alias("_last"))
        .select(
            F.col(user).isNull().alias("no_user"), F.coalesce(F.col(user), F.lit(0).cast(kind)).alias("user_key"), F.window_time("_window").alias("_time"), micros(F.col("_window.start")).alias("cell"),
            F.col(page).cast("string").alias("page"), "views", micros(F.col("_first")).alias("first"),
            micros(F.col("_last")).alias("last"), micros(F.col("_first")).alias("began"), "events",
        )
    )
    fold = SessionFold(gap // MICROSECOND, cell_width(gap) // MICROSECOND)
    closed = fragments.groupBy(*_KEY).transformWithState(
        fold, f"no_user boolean, user_key {kind}, {_REPORT}", "Append", "EventTime"
    )
    at = lambda c: F.timestamp_micros(F.col(c))
    return closed.select(
        F.when(~F.col("no_user"), F.col("user_key")).alias(user), "session_no", at("began").alias("session_min"), at("lasts").alias("session_max"), at("last").alias("last_ts"), "events"
    )


def start_sessions(sessions: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the sessions closed by all data available now to a folder of parquet files; goes on from the checkpoint."""
    # A query keeps the store that is set when it starts.
    with setting(sessions.sparkSession, _STORE, _ROCKSDB):
        return start_fragments(sessions, table, checkpoint)
