from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Row, functions as F

from clicklake.operators.sessions import gap_sessions, sessionize
from clicklake.streaming.sessions import (
    SessionFold, session_stream, start_fragments, start_sessions, stream_fragments, streamed_gap_sessions, streamed_sessions,
)

GAP, DELAY = timedelta(hours=12), timedelta(days=2)


def test_stream_of_several_files_equals_batch(spark, tmp_path):
    """Four files in turn, partly late; whatever the watermark has closed equals the batch result."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    source, table, checkpoint = (str(tmp_path / n) for n in ("source", "table", "checkpoint"))
    columns = ("user_id", "ts", "event_type")
    day = F.dayofmonth("ts")
    # A tenth of the events of a part arrives with the next one, a day late at most.
    late = (F.col("event_id") % 10 == 0) & (day % 7 == 0)
    part = F.floor((day - 1) / 7) + late.cast("int")
    for number in range(5):
        batch = events.where(part == number).select(*columns)
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.select(*columns).schema).parquet(source)
        fragments = stream_fragments(stream, "user_id", "ts", "event_type", GAP, DELAY)
        start_fragments(fragments, table, checkpoint).awaitTermination()
    closed = events.agg(F.max("ts") - F.lit(DELAY)).first()[0]
    cell_end = F.window("ts", "12 hours")["end"]
    seen = events.select(cell_end.alias("e")).where(F.col("e") <= F.lit(closed)).agg(F.max("e")).first()[0]
    # Sessions of all events: none is reported that later events extend, and none is missing that is over.
    batch = sessionize(events, "user_id", "ts", "event_type", GAP)
    got = set(map(tuple, streamed_sessions(spark, table, "user_id", "event_type", GAP).collect()))
    assert got <= set(map(tuple, batch.collect())) and len(got) > 1000
    assert got >= set(map(tuple, batch.where(F.col("session_max") + F.lit(GAP) < F.lit(seen)).collect()))
    gaps = streamed_gap_sessions(spark, table, "user_id", GAP)
    batch = gap_sessions(events, "user_id", "ts", GAP).where(F.col("session_end") < F.lit(seen))
    assert sorted(map(tuple, gaps.collect())) == sorted(map(tuple, batch.collect()))


def run_in_parts(spark, tmp_path, events, parts):
    """The reported sessions after each part; every run starts anew from the checkpoint."""
    source, table, checkpoint = (str(tmp_path / n) for n in ("source", "sessions", "state"))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        closed = session_stream(stream, "user_id", "ts", "event_type", GAP, DELAY)
        start_sessions(closed, table, checkpoint).awaitTermination()
        yield spark.read.parquet(table)


def test_sessions_from_state_equal_batch(spark, tmp_path):
    """Parts of files in turn, partly late, with users and pages that are null."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    day, number = F.dayofmonth("ts"), F.col("event_id") % 10
    part = F.floor((day - 1) / 7) + ((number == 0) & (day % 7 == 0)).cast("int")
    users = F.when(F.col("user_id") % 50 == 7, F.lit(None)).otherwise(F.col("user_id"))
    pages = F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("event_type"))
    placed = events.withColumns({"part": part, "user_id": users, "event_type": pages})
    events = placed.select("user_id", "ts", "event_type")
    parts = [placed.where(F.col("part") == i).select(events.columns) for i in range(5)]
    batch = set(map(tuple, sessionize(events, "user_id", "ts", "event_type", GAP).collect()))
    before = set()
    for sessions in run_in_parts(spark, tmp_path, events, parts):
        rows = [(r.user_id, r.session_no, r.session_min, r.session_max) for r in sessions.collect()]
        assert len(set(rows)) == len(rows) and set(rows) >= before and set(rows) <= batch
        before = set(rows)
    closed = events.agg(F.max("ts") - F.lit(DELAY)).first()[0]
    over = events.select(F.window("ts", "12 hours")["end"].alias("e")).where(F.col("e") <= F.lit(closed)).agg(F.max("e")).first()[0]
    assert before >= {r for r in batch if r[3] + GAP < over} and len(before) > 1000
    assert sessions.where("user_id IS NULL").count() > 0


def test_state_of_a_hot_user_stays_small(spark, tmp_path):
    """A user with nearly all events: what a batch brings to the sessions is a row per cell and page."""
    events = spark.range(40_000).selectExpr(
        "IF(id % 10 = 0, id % 7, 99) AS user_id", "TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, id) AS ts", "'p' || id % 3 AS event_type"
    )
    parts = [events.where(f"ts >= '2024-01-{a:02d}' AND ts < '2024-01-{a + 9:02d}'") for a in (1, 10, 19)]
    (*_, sessions) = run_in_parts(spark, tmp_path, events, [*parts, spark.createDataFrame([], events.schema)])
    assert sessions.count() == 0  # nobody paused for half a day
    later = spark.createDataFrame([(99, "2024-06-01 00:00:00", "p0")], "user_id bigint, ts string, event_type string")
    later = later.withColumn("ts", F.col("ts").cast("timestamp"))
    (sessions,) = run_in_parts(spark, tmp_path, events, [later])
    hot = {r.user_id: r.events for r in sessions.collect()}
    assert hot[99] == events.where("user_id = 99 AND ts < '2024-01-28'").count() and len(hot) == 8


class _Store:
    """State in memory that counts its calls."""

    def __init__(self):
        self.held, self.value, self.calls = {}, None, []

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            if name == "get":
                return self.value
            if name == "update":
                self.value = given[0]
            elif name == "updateValue":
                self.held[given[0]] = given[1]
            elif name == "getValue":
                return self.held.get(given[0])
            elif name == "clear":
                self.held.clear()
            elif name == "exists":
                return self.value is not None
            elif name == "containsKey":
                return given[0] in self.held
        return call


def test_a_batch_asks_the_store_once_per_page():
    """Forty cells in four sessions: the store hears of the pages of the last session, each once."""
    fold = SessionFold(10, 10)
    fold.open, fold.pages, fold.handle = _Store(), _Store(), _Store()

    def batch(cells, pages="ab"):
        rows = [Row(cell=c * 10, first=c * 10, last=c * 10 + 1, page=p, views=1, began=c * 10, events=1) for c in cells for p in pages]
        fold.open.calls, fold.pages.calls = [], []
        return [tuple(r) for r in fold.handleInputRows((False, 7), iter(rows[::-1]), None)]

    cells = [c + 20 * s for s in range(4) for c in range(10)]
    closed = batch(cells)
    assert closed == [(False, 7, s, 200 * s, 200 * s + 101, 200 * s + 91, 20) for s in range(3)]
    assert fold.pages.calls == ["updateValue"] * 2 and fold.open.calls == ["get", "update"]
    assert fold.pages.held == {(False, "a"): (2,), (False, "b"): (2,)}
    # The session goes on with the pages that the store has, and with one that is new.
    assert batch([70], "ac") == [] and fold.pages.calls == ["getValue"] * 2 + ["updateValue"]
    assert fold.pages.held[False, "c"] == (1,) and fold.open.value[:2] == (3, 600)
    assert batch([90], "a") == [(False, 7, 3, 600, 711, 701, 22)]
    assert fold.pages.calls == ["clear", "updateValue"] and fold.pages.held == {(False, "a"): (1,)}
