"""Sessions of the events table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.operators import late_sessions, sessions as ops
from clicklake.operators.windows import lag_by_key, with_group_totals
from clicklake.plans import query
from clicklake.plans.inputs import table
from clicklake.sources.files import read_parquet, shared_dir, write_parquet
from clicklake.streaming.sessions import session_stream, start_fragments, start_sessions, stream_fragments, streamed_gap_sessions

GAP = timedelta(hours=12)
DELAY = timedelta(days=1)
BOUNDARY = "2024-01-15 00:00:00"
COLUMNS = {"user": "user_id", "ts": "ts", "page": "event_type", "gap": GAP}


def _sessions_sql(name: str, source: str) -> str:
    """Sessions of ``source`` (user_id, ts, event_type, prev_min) by windows over whole users."""
    return f"""
{name}_flagged AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS lag_ts FROM {source}
), {name}_numbered AS (
  SELECT *, count(CASE WHEN ts > lag_ts + INTERVAL 12 HOUR THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts)
            AS session_no
  FROM {name}_flagged
), {name}_paged AS (
  SELECT *, count(event_type) OVER (PARTITION BY user_id, session_no, event_type) AS n FROM {name}_numbered
), {name} AS (
  SELECT user_id, session_no, min(coalesce(prev_min, ts)) AS session_min,
         max(CASE WHEN n = 1 THEN ts ELSE ts + INTERVAL 12 HOUR END) AS session_max
  FROM {name}_paged GROUP BY user_id, session_no
)"""


_PLAIN = "SELECT user_id, ts, event_type, NULL::TIMESTAMP AS prev_min FROM events"
_CARRY_SQL = f"""
WITH before AS ({_PLAIN} WHERE ts < TIMESTAMP '{BOUNDARY}'), {_sessions_sql("s", "before")},
carry AS (
  SELECT user_id, session_max AS ts, NULL::VARCHAR AS event_type, session_min AS prev_min FROM s
  WHERE session_max + INTERVAL 12 HOUR > TIMESTAMP '{BOUNDARY}'
)"""


_SESSIONS_SQL = f"WITH plain AS ({_PLAIN}), {_sessions_sql('s', 'plain')} SELECT * FROM s"


@query(_SESSIONS_SQL)
def sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sessionize(table(spark, sf_dir, "events"), **COLUMNS)


@query(_SESSIONS_SQL)
def sessionize_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of users with too many events for one task."""
    return ops.sessionize(table(spark, sf_dir, "events"), **COLUMNS, hot_rows=0)


@query(f"{_CARRY_SQL} SELECT * FROM carry")
def session_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    boundary = F.lit(BOUNDARY).cast("timestamp_ntz")
    closed = table(spark, sf_dir, "events").where(F.col("ts") < boundary)
    return ops.open_sessions(ops.sessionize(closed, **COLUMNS), boundary=boundary, **COLUMNS)


@query(
    f"""{_CARRY_SQL}, following AS (
  {_PLAIN} WHERE ts >= TIMESTAMP '{BOUNDARY}' UNION ALL SELECT * FROM carry
), {_sessions_sql("nxt", "following")} SELECT * FROM nxt"""
)
def session_next_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carry rows are a stored table, as they are between two runs of an hourly job."""
    carry = shared_dir(spark)
    write_parquet(session_carry(spark, sf_dir), carry)
    following = table(spark, sf_dir, "events").where(F.col("ts") >= F.lit(BOUNDARY).cast("timestamp_ntz"))
    return ops.sessionize_next(following, read_parquet(spark, carry), **COLUMNS)


@query(_SESSIONS_SQL)
def session_late_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three windows, each with a tenth of the events of the one before: the sessions are those of all events."""
    events, store = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type"), shared_dir(spark)
    day = F.dayofmonth("ts")
    window = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2) + (F.col("event_id") % 10 == 0).cast("int")
    for number in range(3):
        part = events.where(F.least(window, F.lit(2)) == number)
        late_sessions.absorb(spark, store, part, f"window-{number}", **COLUMNS)
    return late_sessions.current(spark, store, "user_id").drop(late_sessions.LAST)


_GAP_SQL = """
WITH flagged AS (
  SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS b
  FROM events
), numbered AS (
  SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM flagged
)
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS session_start,
       max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS events
FROM numbered GROUP BY user_id, session_no"""


@query(_GAP_SQL)
def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.gap_sessions(table(spark, sf_dir, "events"), "user_id", "ts", GAP)


@query(_GAP_SQL)
def gap_sessions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.gap_sessions(table(spark, sf_dir, "events"), "user_id", "ts", GAP, hot_rows=0)


_LABEL_SQL = f"""
WITH plain AS (SELECT *, NULL::TIMESTAMP AS prev_min FROM events), {_sessions_sql("s", "plain")}
SELECT event_id, session_no FROM s_numbered"""


def _labels(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return ops.label_sessions(events, "user_id", "ts", GAP, **options).select("event_id", "session_no")


@query(_LABEL_SQL)
def label_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)


@query(_LABEL_SQL)
def label_sessions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir, hot_rows=0)


@query(
    """
SELECT event_id, user_id, event_type, max(ts) OVER (PARTITION BY user_id) AS user_last,
       count(event_type) OVER (PARTITION BY user_id, event_type) AS page_count
FROM events"""
)
def window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    totals = {
        ("user_id",): [F.max("ts").alias("user_last")],
        ("user_id", "event_type"): [F.count("event_type").alias("page_count")],
    }
    return with_group_totals(events, totals).drop("ts")


_LAG_SQL = """
SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lag_ts FROM events"""


def _lagged(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return lag_by_key(events, ["user_id"], ["ts", "event_id"], "ts", "lag_ts", **options)


@query(_LAG_SQL)
def lag_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lagged(spark, sf_dir)


@query(_LAG_SQL)
def lag_timestamp_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lagged(spark, sf_dir, hot_rows=10)


# The end of the last cell that the watermark has closed. Sessions are those of all events; what such a
# session's last event plus the gap does not reach is closed.
_SEEN_SQL = """SELECT max(cell_end) FROM (
    SELECT time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 12 HOUR AS cell_end FROM events)
  WHERE cell_end <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""


@query(
    f"""WITH plain AS ({_PLAIN}), {_sessions_sql('s', 'plain')}, last AS (
  SELECT user_id, session_no, max(ts) AS last_ts FROM s_numbered GROUP BY user_id, session_no
)
SELECT s.* FROM s JOIN last USING (user_id, session_no) WHERE last_ts + INTERVAL 12 HOUR < ({_SEEN_SQL})"""
)
def stream_sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that a stream over the events table has closed, as its state reported them."""
    return _streamed(spark, sf_dir).select("user_id", "session_no", "session_min", "session_max")


@query(f"SELECT * FROM ({_GAP_SQL}) WHERE session_end < ({_SEEN_SQL})")
def stream_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the gap rule alone."""
    return _streamed(spark, sf_dir).select(
        "user_id", "session_no", F.col("session_min").alias("session_start"), (F.col("last_ts") + F.lit(GAP)).alias("session_end"), "events"
    )


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A pattern, since a stream takes a plain path for a folder and the table may be a single file.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of a stream over the events table."""
    folder = shared_dir(spark)
    closed = session_stream(_events_stream(spark, sf_dir), "user_id", "ts", "event_type", GAP, DELAY)
    start_sessions(closed, f"{folder}/sessions", f"{folder}/checkpoint").awaitTermination()
    found = read_parquet(spark, f"{folder}/sessions")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_min", "session_max", "last_ts")})


@query(f"SELECT * FROM ({_GAP_SQL}) WHERE session_end < ({_SEEN_SQL})")
def stream_fragment_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap sessions by the batch operator, of fragments that a stream has appended to a table."""
    folder = shared_dir(spark)
    fragments = stream_fragments(_events_stream(spark, sf_dir), "user_id", "ts", "event_type", GAP, DELAY)
    start_fragments(fragments, f"{folder}/fragments", f"{folder}/checkpoint").awaitTermination()
    sessions = streamed_gap_sessions(spark, f"{folder}/fragments", "user_id", GAP)
    return sessions.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
