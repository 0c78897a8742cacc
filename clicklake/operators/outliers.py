"""Outliers and growth of counted page views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clicklake.functions.numbers import growth
from clicklake.operators.skew import HOT_ROWS
from clicklake.operators.windows import lag_by_key


def sigma_outliers(df: DataFrame, day: str, key: str, k: float = 3.0, center: bool = False) -> DataFrame:
    """Days on which a key has more than ``k`` sample deviations of views (above its mean if ``center``).

    Views are counted before any key is windowed, so a key brings one row per
    day however often it was seen. A key seen on one day has no deviation and
    no outlier.
    """
    views = df.groupBy(key, day).agg(F.count("*").alias("page_views"))
    by_key = Window.partitionBy(key)
    deviation = F.stddev("page_views").over(by_key)
    limit = F.col("stddev") * F.lit(float(k))
    if center:
        limit = limit + F.col("mean")
    return (
        views.withColumns({"stddev": deviation, "mean": F.avg("page_views").over(by_key)})
        .withColumn("upper_limit", limit)
        .withColumn("is_outlier", F.col("page_views") > F.col("upper_limit"))
        .where("is_outlier")
        .select(key, day, "page_views", "stddev", "upper_limit", "is_outlier")
    )


def growth_curve(
    df: DataFrame, key: str, order: str, count: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Mean growth over the previous row of the same key, by ``order`` from 0 on.

    A key's first row has growth 0. ``order`` is a whole number.
    """
    lagged = lag_by_key(df.select(key, order, count), [key], [order], count, "_previous", hot_rows)
    pct = F.coalesce(growth(F.col(count), F.col("_previous")), F.lit(0.0))
    return lagged.where(F.col(order) >= 0).groupBy(order).agg(F.avg(pct).alias("avg_pct"))
