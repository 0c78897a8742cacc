"""Column profiles as metric rows (date_, type_, name, value). Metrics never visit the driver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.functions.times import is_weekday
from clicklake.sources.files import settled

# Metric names in the metrics table.
METRICS = ["ApproxQuantile-0.5", "Mean", "StandardDeviation", "Maximum", "Minimum"]
BINS, BIN_COUNT, BIN_RATIO, NULL_BIN = "Histogram.bins", "Histogram.abs.", "Histogram.ratio.", "NullValue"


def _moments(c: Column, accuracy: int) -> list[Column]:
    c = c.cast("double")
    return [F.percentile_approx(c, 0.5, accuracy), F.avg(c), F.stddev_pop(c), F.max(c), F.min(c)]


def _metric_rows(df: DataFrame, type_: Column, name: Column, value: Column, day: date | None) -> DataFrame:
    """Metrics that have a value; those of no rows have none."""
    metrics = df.select(
        F.lit(day).cast("date").alias("date_"), type_.alias("type_"), name.alias("name"), value.alias("value")
    )
    return metrics.where(F.col("value").isNotNull())


def _histogram_rows(bins: DataFrame, type_: Column, day: date | None) -> DataFrame:
    """``bins`` hold (bin, n, total) and what ``type_`` needs."""
    rows = bins.select(
        type_.alias("_type"),
        F.explode(
            F.array(
                F.struct(F.concat(F.lit(BIN_COUNT), "bin").alias("name"), F.col("n").cast("double").alias("value")),
                F.struct(F.concat(F.lit(BIN_RATIO), "bin").alias("name"), (F.col("n") / F.col("total")).alias("value")),
            )
        ).alias("m"),
    )
    return _metric_rows(rows, F.col("_type"), F.col("m.name"), F.col("m.value"), day)


def _of_day(df: DataFrame, day: date | None, date_col: str) -> DataFrame:
    return df if day is None else df.where(F.col(date_col) == F.lit(day))


def _bin(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL_BIN)).alias("bin")


def profile_column(
    df: DataFrame, column: str, type_: str = "default", day: date | None = None, date_col: str = "date_",
    accuracy: int = 10_000,
) -> DataFrame:
    """Median, mean, population deviation, maximum and minimum of a column in one aggregate."""
    stats = _of_day(df, day, date_col).agg(*[m.alias(n) for n, m in zip(METRICS, _moments(F.col(column), accuracy))])
    rows = stats.unpivot([], [F.col(f"`{n}`") for n in METRICS], "name", "value")
    return _metric_rows(rows, F.lit(type_), F.col("name"), F.col("value"), day)


def profile_histogram(
    df: DataFrame, column: str, type_: str = "default", day: date | None = None, date_col: str = "date_"
) -> DataFrame:
    """How many bins a column has, and the count and share of each, from one pass over the data."""
    bins = settled(_of_day(df, day, date_col).groupBy(_bin(column)).agg(F.count("*").alias("n")))
    number = _metric_rows(
        bins.agg(F.count("*").cast("double").alias("n")), F.lit(type_), F.lit(BINS), F.col("n"), day
    )
    total = bins.agg(F.sum("n")).scalar()
    return number.unionByName(_histogram_rows(bins.withColumn("total", total), F.lit(type_), day))


def profile(df: DataFrame, column: str, type_: str = "default", day: date | None = None, **options) -> DataFrame:
    """All metrics of a column."""
    moments = profile_column(df, column, type_, day, **options)
    return moments.unionByName(profile_histogram(df, column, type_, day))


def profile_by_day_type(
    df: DataFrame, column: str, date_col: str, label: str, cap: int, accuracy: int = 10_000
) -> DataFrame:
    """Profiles of weekdays and weekends, each over all values and over those up to ``cap``.

    Two passes over the data replace eight: the capped metrics are conditional
    aggregates next to the others, and capped bins are a subset of all bins.
    """
    data = df.withColumn("_weekday", is_weekday(F.col(date_col))).where(F.col("_weekday").isNotNull())
    days = F.when(F.col("_weekday") == 1, F.lit("weekdays")).otherwise(F.lit("weekends"))
    c = F.col(column)
    variants = {"total": c, str(cap): F.when(c <= cap, c)}

    stats = data.groupBy("_weekday").agg(
        *[m.alias(f"{n}|{v}") for v, x in variants.items() for n, m in zip(METRICS, _moments(x, accuracy))]
    )
    rows = stats.unpivot(["_weekday"], [F.col(f"`{n}|{v}`") for v in variants for n in METRICS], "key", "value")
    type_ = F.concat_ws("_", F.lit(label), days, F.substring_index("key", "|", -1))
    moments = _metric_rows(rows, type_, F.substring_index("key", "|", 1), F.col("value"), None)

    bins = settled(data.groupBy("_weekday", c.alias("_value")).agg(F.count("*").alias("n")))
    both = bins.withColumn(
        "_variant",
        F.explode(F.when(F.col("_value") <= cap, F.array(*map(F.lit, variants))).otherwise(F.array(F.lit("total")))),
    ).withColumn("bin", _bin("_value"))
    group = ["_weekday", "_variant"]
    totals = both.groupBy(*group).agg(F.sum("n").alias("total"), F.count("*").alias("bins"))
    type_ = F.concat_ws("_", F.lit(label), days, "_variant")
    number = _metric_rows(totals, type_, F.lit(BINS), F.col("bins").cast("double"), None)
    # Two day types in two variants: the totals are four rows at most.
    shares = _histogram_rows(both.join(F.broadcast(totals), group), type_, None)
    return moments.unionByName(number).unionByName(shares)
