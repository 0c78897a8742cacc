from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import plan
from pyspark.sql import functions as F

from clicklake.operators import sessions as ops
from clicklake.operators.skew import split_hot
from clicklake.operators.windows import lag_by_key, slices, with_group_totals

GAP = timedelta(seconds=30)
SCHEMA = "user_id int, ts timestamp, page_key string"
NAMES = {"user": "user_id", "ts": "ts", "page": "page_key", "gap": GAP}


def at(text: str) -> datetime:
    minute, second = text.split(":")
    return datetime(2021, 3, 4, 9, int(minute), int(second))


FIRST = [
    (5, "03:00", "s"), (5, "03:30", "s"), (7, "01:00", "x"), (7, "01:20", "y"), (7, "01:40", "x"), (7, "02:40", "z"),
    (7, "09:30", "p"), (7, "09:50", "q"), (9, "09:25", "r"),
]
SECOND = [(7, "10:15", "q"), (7, "11:00", "t"), (9, "10:05", "r")]


def frame(spark, rows):
    return spark.createDataFrame([(u, at(t), p) for u, t, p in rows], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.select("user_id", "session_no", "session_min", "session_max").collect())


def expected(rows):
    return sorted((u, n, at(a), at(b)) for u, n, a, b in rows)


def test_two_windows_with_carry(spark):
    first = ops.sessionize(frame(spark, FIRST), **NAMES)
    assert found(first) == expected([
        (5, 0, "03:00", "04:00"), (7, 0, "01:00", "02:10"), (7, 1, "02:40", "02:40"), (7, 2, "09:30", "09:50"),
        (9, 0, "09:25", "09:25"),
    ])
    carry = ops.open_sessions(first, boundary=F.lit(at("10:00")), **NAMES)
    assert [tuple(r) for r in carry.collect()] == [(7, at("09:50"), None, at("09:30"))]
    second = ops.sessionize_next(frame(spark, SECOND), carry, **NAMES)
    # The carry row alone would last until 10:20.
    assert found(second) == expected([
        (7, 0, "09:30", "10:20"), (7, 1, "11:00", "11:00"), (9, 0, "10:05", "10:05"),
    ])


def test_exactly_one_gap_apart_is_one_session(spark):
    rows = [(1, "00:00", "a"), (1, "00:30", "b"), (1, "01:01", "c")]
    assert found(ops.sessionize(frame(spark, rows), **NAMES)) == expected([
        (1, 0, "00:00", "00:30"), (1, 1, "01:01", "01:01"),
    ])


def test_gap_of_a_day_where_clocks_change(spark):
    """The day before the clocks go forward has 23 hours; both ways agree on what a day later means."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    df = spark.sql("""
        select 1 as user_id, 'p' as page_key, timestamp_seconds(1711753200 + col * 1380) as ts
        from (select explode(sequence(0, 400, 7)) as col) union all
        select 2, 'q', timestamp_seconds(1711753200 + 3600 * col) from (select explode(array(0, 23, 46, 70)) as col)""")
    names = {**NAMES, "gap": timedelta(days=1)}
    ways = [sorted(map(tuple, ops.sessionize(df, hot_rows=n, **names).collect())) for n in (0, 10**6)]
    spark.conf.set("spark.sql.session.timeZone", before)
    assert ways[0] == ways[1]


def test_pages_may_be_numbers(spark):
    df = spark.createDataFrame([(1, at("00:00"), 5), (1, at("00:10"), 5)], "user_id int, ts timestamp, page_key int")
    carry = ops.open_sessions(ops.sessionize(df, **NAMES), boundary=F.lit(at("00:41")), **NAMES)
    later = spark.createDataFrame([(1, at("01:05"), 6)], "user_id int, ts timestamp, page_key int")
    assert found(ops.sessionize_next(later, carry, **NAMES)) == expected([(1, 0, "00:00", "01:10")])


def brute_force(rows, gap):
    """The rules, read row by row: rows are (user, ts, page, prev_min)."""
    by_user = defaultdict(list)
    for row in rows:
        by_user[row[0]].append(row)
    result = []
    for user, events in by_user.items():
        events.sort(key=lambda r: (r[1] is not None, r[1]))
        number, last, sessions = 0, None, defaultdict(list)
        for event in events:
            if last is not None and event[1] > last + gap:
                number += 1
            sessions[number].append(event)
            last = event[1]
        for number, members in sessions.items():
            views = Counter(r[2] for r in members if r[2] is not None)
            starts = [r[3] or r[1] for r in members if r[3] or r[1]]
            ends = [r[1] if views[r[2]] == 1 else r[1] + gap for r in members if r[1]]
            result.append((user, number, min(starts, default=None), max(ends, default=None)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("hot_rows", [0, 500, 10**6])
def test_against_brute_force_with_a_hot_user(spark, hot_rows):
    """A third of the rows belongs to nobody, another third to one user; ties and lost times occur."""
    rng, rows = random.Random(hot_rows), []
    start = datetime(2024, 1, 1)
    for _ in range(3000):
        user = rng.choice([None, 7, rng.randrange(60)])
        ts = start + timedelta(microseconds=rng.choice([rng.randrange(3 * 10**9), rng.randrange(200) * 15 * 10**6]))
        page = rng.choice([None, *"abcdefgh"])
        rows.append((user, None if rng.random() < 0.01 else ts, page, ts - GAP if rng.random() < 0.02 else None))
    df = spark.createDataFrame(rows, "user_id int, ts timestamp, page_key string, prev_min timestamp")
    got = ops.sessionize(df, prev_min="prev_min", hot_rows=hot_rows, **NAMES).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_force(rows, GAP)


@pytest.mark.parametrize("hot_rows", [0, 100, 10**6])
def test_labels_and_gap_sessions_cover_all_events(spark, hot_rows):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, rng.randrange(9)]), at("00:00") + timedelta(seconds=rng.randrange(4000)), "p") for _ in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    labelled = ops.label_sessions(df, "user_id", "ts", GAP, hot_rows)
    by_label = labelled.groupBy("user_id", "session_no").agg(
        F.min("ts").alias("a"), (F.max("ts") + F.lit(GAP)).alias("b"), F.count("*").alias("n")
    )
    sessions = ops.gap_sessions(df, "user_id", "ts", GAP, hot_rows)
    assert sorted(map(tuple, sessions.collect()), key=repr) == sorted(map(tuple, by_label.collect()), key=repr)
    assert sessions.agg(F.sum("events")).first()[0] == len(rows)


def test_ordinary_users_take_one_shuffle(spark, no_broadcast):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    text = plan(ops.sessionize(df, "user_id", "ts", "event_type", GAP))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_only_hot_users_are_split(spark):
    rows = [(u, at("00:00"), "p") for u in [None] * 50 + [1] * 20 + list(range(2, 30))]
    df = spark.createDataFrame(rows, SCHEMA)
    ordinary, hot = split_hot(df, ["user_id"], 20)
    assert ordinary.count() == 48 and hot.count() == 50 and hot.where("user_id is not null").isEmpty()
    everything, nothing = split_hot(df, ["user_id"], 50)
    assert nothing is None and everything.count() == len(rows)


def test_no_window_sees_events_of_hot_users(spark, no_broadcast):
    """Windows run over one row per user and cell; everything is combined before its first shuffle."""
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    text = plan(ops.sessionize(df, "user_id", "ts", "event_type", GAP, hot_rows=0))
    lines = [line.strip(" :+-*()0123456789") for line in text.splitlines()]
    for window in [i for i, line in enumerate(lines) if line.startswith("Window")]:
        below = [line for line in lines[window:] if line.startswith(("HashAggregate", "FileScan"))]
        assert below[0].startswith("HashAggregate") and "_cell" in below[0]
    exchanges = [i for i, line in enumerate(lines) if line.startswith("Exchange")]
    for scan in [i for i, line in enumerate(lines) if line.startswith("FileScan")]:
        nearest = max(i for i in exchanges if i < scan)
        assert any("partial_" in line for line in lines[nearest:scan])


@pytest.mark.parametrize("hot_rows", [0, 1, 37, 500, 10**6])
def test_lag_by_key_equals_a_plain_lag(spark, hot_rows):
    rng = random.Random(1)
    rows = [
        (rng.choice([None, "hot", "hot", f"k{rng.randrange(50)}"]),
         None if i % 71 == 0 else at("00:00") + timedelta(seconds=rng.randrange(9000)),
         i, rng.choice([None, f"v{i}"]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, v string")
    got = lag_by_key(df, ["k"], ["ts", "id"], "v", "before", hot_rows, 100)
    plain = df.selectExpr("*", "lag(v) over (partition by k order by ts, id) as before")
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_lag_shuffles_hot_rows_by_slice(spark, no_broadcast):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    text = plan(lag_by_key(df, ["user_id"], ["ts"], "value", "before", hot_rows=0))
    assert "hashpartitioning(user_id#" in text and "_slice" in text
    assert text.count("Window [lag") == 1


@pytest.mark.parametrize("second", ["0", "if(id = 0, -1000000000, id)", "id * id"])
def test_slices_are_even_however_rows_lie_in_time(spark, second):
    """Equal times, a burst with one clock of long ago, and times that spread out."""
    df = spark.range(20_000).selectExpr("'hot' as k", f"timestamp_seconds({second}) as ts", "id")
    sizes = slices(df, ["k"], ["ts", "id"], 2000).groupBy("_slice").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    found = sizes.orderBy("_slice").collect()
    assert len(found) == 10 and max(r.n for r in found) < 4000 and sum(r.n for r in found) == 20_000
    assert [r.low for r in found] == sorted(r.low for r in found)


def test_group_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v int")
    got = with_group_totals(df, {("k",): [F.max("v").alias("top"), F.count("*").alias("n")]})
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", 5, 5, 1), (None, 1, 2, 2), (None, 2, 2, 2)]
