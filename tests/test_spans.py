"""Spans of days merged from daily rows."""

from __future__ import annotations

import math
import random
import statistics
from datetime import date, timedelta

from pyspark.sql import functions as F

from clicklake.operators import spans

DAY = date(2024, 1, 1)


def test_a_month_of_thirty_rows(spark):
    rng = random.Random(8)
    rows = [(DAY + timedelta(rng.randrange(30)), None if rng.random() < 0.05 else rng.choice([rng.gauss(1e6, 5), rng.random()]), rng.randrange(70_000))
            for _ in range(30_000)]
    df = spark.createDataFrame(rows, "day date, value double, user_id long")
    days = spans.daily_moments(df, "day", "value")
    assert days.count() == 30
    got = spans.merged_moments(days, quantiles=[0.01, 0.5, 0.9]).first()
    values = sorted(v for _, v, _ in rows if v is not None)
    assert (got.n, got.nulls, got.low, got.high) == (len(values), len(rows) - len(values), values[0], values[-1])
    assert math.isclose(got["mean"], statistics.fmean(values), rel_tol=1e-12)
    assert math.isclose(got.deviation, statistics.pstdev(values), rel_tol=1e-9)
    for q in (0.01, 0.5, 0.9):
        rank = sum(v <= got[f"q{q:g}"] for v in values) / len(values)
        assert abs(rank - q) < 0.005
    users = spans.distinct_ids(spans.daily_ids(df, "day", "user_id")).first()[0]
    assert users == len({u for *_, u in rows})
    first = spans.distinct_ids(spans.daily_ids(df, "day", "user_id").where(F.col("day") < F.lit(DAY + timedelta(7)))).first()[0]
    assert first == len({u for d, _, u in rows if d < DAY + timedelta(7)})


def test_bins_days_without_values_and_no_days(spark):
    df = spark.createDataFrame([(DAY, None, None), (DAY, None, 1), (DAY + timedelta(1), 2.0, 40_000), (DAY + timedelta(1), 2.0, -1)], "day date, value double, user_id long")
    days = spans.daily_moments(df, "day", "value")
    got = {r.day: (r.n, r.nulls, r["mean"], r["q0.5"]) for r in spans.merged_moments(days, ["day"]).collect()}
    assert got == {DAY: (0, 2, None, None), DAY + timedelta(1): (2, 0, 2.0, 2.0)}
    whole = spans.merged_moments(days).first()
    assert (whole.n, whole.nulls, whole.deviation) == (2, 2, 0.0)
    bins = {r.bin: r.n for r in spans.merged_bins(spans.daily_bins(df, "day", "value")).collect()}
    assert bins == {None: 2, "2.0": 2}
    assert spans.distinct_ids(spans.daily_ids(df, "day", "user_id")).first()[0] == 3
    assert spans.distinct_ids(spans.daily_ids(df.limit(0), "day", "user_id")).first()[0] == 0
    assert spans.merged_moments(days.limit(0)).first().n is None
