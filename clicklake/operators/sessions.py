"""Gap sessions with the bounce rule.

A user's next session starts at an event more than ``gap`` after the one before.
A page seen once in a session is a bounce and lasts no time; any other page
lasts ``gap`` beyond its last event. A session ends with its last page.

Ordinary users are windowed: one shuffle by user serves the window and all
aggregates behind it. Users with more events than a task should sort take
another way, in which no step sorts or windows events. The time line is cut into
cells no wider than a gap. Two events in the same cell are less than a gap
apart, so a cell never spans two sessions, and plain aggregation can shrink the
events to one fragment per user, cell and page before the first shuffle. Session
borders then follow from one row per user and cell: a user with a third of all
events has no more of those than the time span has cells.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.functions.times import time_slice
from clicklake.operators.joins import null_safe_join
from clicklake.operators.skew import HOT_ROWS, split_hot, together

CELL = "_cell"


def cell_width(gap: timedelta) -> timedelta:
    """Width of the cells: the gap, or half of it where a day may be shorter than 24 hours."""
    return gap if gap < timedelta(days=1) else gap / 2


def _number_events(df: DataFrame, user: str, ts: str, gap: timedelta) -> DataFrame:
    # Events at the same time share the number, as the default window frame has it.
    by_user = Window.partitionBy(user).orderBy(ts)
    breaks = F.col(ts) > F.lag(ts).over(by_user) + F.lit(gap)
    return (
        df.withColumn("_breaks", breaks)
        .withColumn("session_no", F.count(F.when(F.col("_breaks"), 1)).over(by_user))
        .drop("_breaks")
    )


def _page_views(df: DataFrame, keys: list[Column | str], ts: str, page: str | None, prev_min: str | None) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(page or ts).alias("views"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.min(F.coalesce(prev_min, ts) if prev_min else ts).alias("began"),
    )


def _close_sessions(
    pages: DataFrame, user: str, gap: timedelta, seen_until: Column | None = None, last: str | None = None
) -> DataFrame:
    lasts_until = F.when(F.col("views") == 1, F.col("last_ts")).otherwise(F.col("last_ts") + F.lit(gap))
    found = pages.groupBy(user, "session_no").agg(
        F.min("began").alias("session_min"), F.max(lasts_until).alias("session_max"), F.max("last_ts").alias("_last")
    )
    if seen_until is not None:
        found = found.where(F.col("_last") + F.lit(gap) < seen_until)
    return found.withColumnRenamed("_last", last) if last else found.drop("_last")


def session_fragments(
    df: DataFrame, user: str, ts: str, page: str, gap: timedelta, prev_min: str | None = None
) -> DataFrame:
    """Events combined per user, cell and page."""
    return _page_views(df, [user, time_slice(df, ts, cell_width(gap)).alias(CELL), page], ts, page, prev_min)


def event_spans(df: DataFrame, user: str, ts: str, gap: timedelta) -> DataFrame:
    """Events as spans of no length, for ``number_cells``."""
    return df.select(
        user, time_slice(df, ts, cell_width(gap)).alias(CELL), F.col(ts).alias("first_ts"), F.col(ts).alias("last_ts")
    )


def number_cells(spans: DataFrame, user: str, gap: timedelta) -> DataFrame:
    """One row per user and cell with its session number, counted from 0."""
    cells = spans.groupBy(user, CELL).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    by_user = Window.partitionBy(user).orderBy(CELL)
    breaks = F.col("first_ts") > F.lag("last_ts").over(by_user) + F.lit(gap)
    return (
        cells.withColumn("_breaks", F.when(breaks, 1).otherwise(0))
        .withColumn("session_no", F.sum("_breaks").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
        .select(user, CELL, "session_no")
    )


def sessions_from_fragments(
    fragments: DataFrame, user: str, page: str, gap: timedelta, spans: DataFrame | None = None,
    seen_until: Column | None = None, last: str | None = None,
) -> DataFrame:
    """(user, session_no, session_min, session_max) of fragments from a batch or a stream.

    ``spans`` may give a cheaper way to the cells than the fragments themselves. Sessions that an event at
    ``seen_until`` or later could extend are left out. ``last`` names a column for the time of the last event.
    """
    numbers = number_cells(fragments if spans is None else spans, user, gap)
    pages = (
        null_safe_join(fragments, numbers, [user, CELL])
        .groupBy(user, "session_no", page)
        .agg(F.sum("views").alias("views"), F.max("last_ts").alias("last_ts"), F.min("began").alias("began"))
    )
    return _close_sessions(pages, user, gap, seen_until, last)


def sessionize(
    df: DataFrame, user: str, ts: str, page: str, gap: timedelta, prev_min: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sessions of all users; ``prev_min`` names the carried start of a session that was still open.

    For hot users the events are read twice, by their time for the cells and in
    full for the fragments; both passes combine what they read before it is
    shuffled.
    """
    ordinary, hot = split_hot(df, [user], hot_rows)
    if ordinary is not None:
        numbered = _number_events(ordinary, user, ts, gap)
        ordinary = _close_sessions(_page_views(numbered, [user, "session_no", page], ts, page, prev_min), user, gap)
    if hot is not None:
        fragments = session_fragments(hot, user, ts, page, gap, prev_min)
        hot = sessions_from_fragments(fragments, user, page, gap, event_spans(hot, user, ts, gap))
    return together(ordinary, hot)


def _merge_spans(spans: DataFrame, user: str, gap: timedelta, events: str) -> DataFrame:
    return spans.groupBy(user, "session_no").agg(
        F.min("first_ts").alias("session_start"),
        (F.max("last_ts") + F.lit(gap)).alias("session_end"),
        F.sum(events).alias("events"),
    )


def gap_sessions_from_fragments(fragments: DataFrame, user: str, gap: timedelta) -> DataFrame:
    """Sessions by the gap rule alone, of fragments with their number of ``events``."""
    numbered = null_safe_join(fragments, number_cells(fragments, user, gap), [user, CELL])
    return _merge_spans(numbered, user, gap, "events")


def gap_sessions(df: DataFrame, user: str, ts: str, gap: timedelta, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sessions by the gap rule alone: they end one gap after their last event."""
    ordinary, hot = split_hot(df, [user], hot_rows)
    if ordinary is not None:
        numbered = _number_events(ordinary, user, ts, gap)
        ordinary = _merge_spans(_page_views(numbered, [user, "session_no"], ts, None, None), user, gap, "views")
    if hot is not None:
        cells = _page_views(hot, [user, time_slice(hot, ts, cell_width(gap)).alias(CELL)], ts, None, None)
        numbers = number_cells(event_spans(hot, user, ts, gap), user, gap)
        hot = _merge_spans(null_safe_join(cells, numbers, [user, CELL]), user, gap, "views")
    return together(ordinary, hot)


def label_sessions(df: DataFrame, user: str, ts: str, gap: timedelta, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every event with its ``session_no``."""
    ordinary, hot = split_hot(df, [user], hot_rows)
    if ordinary is not None:
        ordinary = _number_events(ordinary, user, ts, gap)
    if hot is not None:
        numbers = number_cells(event_spans(hot, user, ts, gap), user, gap)
        in_cells = hot.withColumn(CELL, time_slice(hot, ts, cell_width(gap)))
        hot = null_safe_join(in_cells, numbers, [user, CELL]).drop(CELL)
    return together(ordinary, hot)


def _still_open(gap: timedelta, boundary: Column) -> Column:
    return F.col("session_max") + F.lit(gap) > boundary


def closed_sessions(sessions: DataFrame, gap: timedelta, boundary: Column) -> DataFrame:
    """The sessions that :func:`open_sessions` leaves."""
    return sessions.where(~F.coalesce(_still_open(gap, boundary), F.lit(False)))


def open_sessions(
    sessions: DataFrame, user: str, ts: str, page: str, gap: timedelta, boundary: Column, prev_min: str = "prev_min"
) -> DataFrame:
    """Carry rows for sessions that an event after ``boundary`` could still extend.

    A carry row stands at the session's end, without a page, and remembers the
    session's start; put it in front of the next batch of events.
    """
    still_open = sessions.where(_still_open(gap, boundary))
    page_type = F.lit(None).cast("string")
    return still_open.select(
        F.col(user), F.col("session_max").alias(ts), page_type.alias(page), F.col("session_min").alias(prev_min)
    )


def sessionize_next(
    events: DataFrame, carry: DataFrame, user: str, ts: str, page: str, gap: timedelta, prev_min: str = "prev_min",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sessions of a further batch of events that continues the carried ones."""
    carry = carry.withColumn(page, F.col(page).cast(events.schema[page].dataType))
    both = events.select(user, ts, page).unionByName(carry, allowMissingColumns=True)
    return sessionize(both, user, ts, page, gap, prev_min, hot_rows)
