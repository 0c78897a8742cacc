"""Sessions over windows with late events, and tables that are appended to in runs."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from clicklake.operators.late_sessions import LAST, absorb, current
from clicklake.operators.sessions import sessionize
from clicklake.sources import runs

NAMES = {"user": "user_id", "ts": "ts", "page": "page", "gap": timedelta(seconds=30)}


def events(spark, rows):
    return spark.createDataFrame(rows, "user_id long, at long, page string").select("user_id", F.timestamp_seconds("at").alias("ts"), "page")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_events(spark, seed, n=600):
    number = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(seed + salt)), F.lit(m))
    return spark.range(n).select(
        F.when(number(1, 9) > 0, number(1, 9)).alias("user_id"), F.timestamp_seconds(number(2, 6000)).alias("ts"),
        F.when(number(3, 5) > 0, number(3, 5).cast("string")).alias("page"), number(4, 10).alias("late"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_with_late_events_equal_one_batch(spark, tmp_path, seed):
    store, whole = str(tmp_path), random_events(spark, seed)
    window = (F.unix_seconds("ts") / 2000).cast("int")
    # Some come one window late, some at the very end, whatever sessions they then join together.
    taken = F.when(F.col("late") == 0, 3).when(F.col("late") == 1, window + 1).otherwise(window)
    for number in range(4):
        absorb(spark, store, whole.where(taken == number).drop("late"), f"w{number}", **NAMES)
        seen = whole.where(taken <= number).drop("late")
        assert rows(current(spark, store, "user_id").drop(LAST)) == rows(sessionize(seen, **NAMES))


def test_only_what_late_events_touch_is_written(spark, tmp_path):
    store = str(tmp_path)
    absorb(spark, store, events(spark, [(u, 100 * k, "a") for u in range(5) for k in range(10)]), "first", **NAMES)
    absorb(spark, store, events(spark, [(3, 520, "a")]), "second", **NAMES)
    written = runs.read_runs(spark, store, "sessions").where("seq = 2")
    # User 3 alone, from the session on that the event extends.
    assert rows(written.select("user_id", "session_no")) == [(3, n) for n in range(5, 10)]
    assert current(spark, store, "user_id").count() == 50


def test_last_run_can_be_repeated(spark, tmp_path):
    store, first, second = str(tmp_path), events(spark, [(1, 0, "a"), (None, 5, None)]), events(spark, [(1, 20, "a"), (2, 50, "b")])
    absorb(spark, store, first, "a", **NAMES)
    for _ in range(2):
        absorb(spark, store, second, "b", **NAMES)
    assert rows(current(spark, store, "user_id").drop(LAST)) == rows(sessionize(first.union(second), **NAMES))
    absorb(spark, store, second.limit(0), "c", **NAMES)
    assert current(spark, store, "user_id").count() == 3
    with pytest.raises(ValueError, match="followed"):
        absorb(spark, store, second, "b", **NAMES)


def test_runs_replace_themselves_and_half_runs_are_not_seen(spark, tmp_path):
    root = str(tmp_path)
    assert runs.read_runs(spark, root, "metrics") is None
    for _ in range(2):
        runs.append_run(spark.range(3), root, "metrics", "2024-01-01/total")
    runs.append_run(spark.range(10, 12), root, "metrics", "2024-01-02/total")
    assert rows(runs.read_runs(spark, root, "metrics")) == [(0,), (1,), (10,), (11,), (2,)]
    dead = runs.begin(spark, root, "2024-01-02/total")
    dead.write(spark.range(99), "metrics")  # and never commits
    assert runs.read_runs(spark, root, "metrics").count() == 5
    runs.append_run(spark.range(1), root, "metrics", "2024-01-01/total")
    assert rows(runs.read_runs(spark, root, "metrics")) == [(0,), (10,), (11,)]
    assert rows(runs.read_runs(spark, root, "metrics", besides="2024-01-02/total")) == [(0,)]
