"""Profiles and distinct counts of any span of days from small rows kept per day.

A day leaves one row of moments with a sketch of its values, one row per bin, and one bitmap per 32,768 ids. All of them
can be merged, so a month is thirty rows and not its events. Counts, means, deviations, extremes, bins and distinct
counts of ids are exact. Quantiles come from the sketch, whose rank error falls with its size ``k`` (about 0.1 % for
4,096), however many days are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SKETCH_SIZE = 4096


def daily_moments(df: DataFrame, day: str, column: str, k: int = SKETCH_SIZE) -> DataFrame:
    """(day, n, nulls, mean, m2, low, high, sketch) per day; ``m2`` is the sum of squared deviations from the day's mean."""
    value = F.col(column).cast("double")
    return df.groupBy(day).agg(
        F.count(value).alias("n"), F.count(F.when(value.isNull(), 1)).alias("nulls"), F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.kll_sketch_agg_double(value, k).alias("sketch"),
    )


def daily_bins(df: DataFrame, day: str, column: str) -> DataFrame:
    """(day, bin, n) per day and value, null values under a null bin."""
    return df.groupBy(day, F.col(column).cast("string").alias("bin")).agg(F.count("*").alias("n"))


def merged_moments(daily: DataFrame, keys: Sequence[str] = (), quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Moments of the days of each group of ``keys``, with a column ``q<number>`` per quantile; null where there are no values."""
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / F.nullif(total, F.lit(0))
    # Deviations within the days plus those of the days' means.
    squares = F.sum("m2") + F.sum(F.col("n") * F.col("mean") * F.col("mean")) - total * mean * mean
    out = daily.groupBy(*keys).agg(
        total.alias("n"), F.sum("nulls").alias("nulls"), mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), squares) / F.nullif(total, F.lit(0))).alias("deviation"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("_sketch"),
    )
    asked = {f"q{q:g}": F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q)))) for q in quantiles}
    return out.withColumns(asked).drop("_sketch")


def merged_bins(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))


def daily_ids(df: DataFrame, day: str, column: str) -> DataFrame:
    """(day, bucket, ids): bitmaps of the ids of a day, which should be dense whole numbers; nulls are no ids."""
    known = df.where(F.col(column).isNotNull())
    return known.groupBy(day, F.bitmap_bucket_number(column).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("ids")
    )


def distinct_ids(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exact numbers of distinct ids of the days of each group: bitmaps are united per bucket, then counted."""
    united = daily.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return united.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).alias("distinct_ids"))
