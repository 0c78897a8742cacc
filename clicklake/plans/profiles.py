"""Column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.operators import isolation, profile as ops, spans
from clicklake.operators.aggregates import distinct_per_column as count_distinct_per_column
from clicklake.plans import query
from clicklake.plans.inputs import table
from clicklake.sources.files import append_metrics, settled, shared_dir
from clicklake.sources.runs import append_run, read_runs


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({"date_": F.col("date_").cast("string"), "value": F.round("value", 6)})


def _moments_sql(source: str, type_: str, column: str) -> str:
    names = {
        "ApproxQuantile-0.5": f"quantile_disc({column}, 0.5)",
        "Mean": f"avg({column})",
        "StandardDeviation": f"stddev_pop({column})",
        "Maximum": f"max({column})",
        "Minimum": f"min({column})",
    }
    rows = [
        f"SELECT NULL::VARCHAR AS date_, '{type_}' AS type_, '{name}' AS name, round(({sql})::DOUBLE, 6) AS value "
        f"FROM {source}"
        for name, sql in names.items()
    ]
    return "\nUNION ALL ".join(rows)


def _histogram_sql(source: str, type_: str, column: str) -> str:
    bins = f"(SELECT coalesce({column}::VARCHAR, 'NullValue') AS bin, count(*) AS n FROM {source} GROUP BY 1)"
    head = f"SELECT NULL::VARCHAR AS date_, '{type_}' AS type_,"
    return f"""{head} 'Histogram.bins' AS name, count(*)::DOUBLE AS value FROM {bins}
UNION ALL {head} 'Histogram.abs.' || bin AS name, n::DOUBLE AS value FROM {bins}
UNION ALL {head} 'Histogram.ratio.' || bin AS name,
       round(n / (SELECT count(*) FROM {source}), 6) AS value FROM {bins}"""


@query(_moments_sql("events", "value", "value"))
def profile_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ops.profile_column(table(spark, sf_dir, "events"), "value", "value"))


@query(_histogram_sql("part", "size", "p_size"))
def profile_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ops.profile_histogram(table(spark, sf_dir, "part"), "p_size", "size"))


_DAILY_SQL = """
daily AS (
  SELECT user_id, CAST(ts AS DATE) AS date_, count(*) AS views FROM events GROUP BY 1, 2
), weekdays AS (SELECT views FROM daily WHERE dayofweek(date_) BETWEEN 1 AND 5
), weekends AS (SELECT views FROM daily WHERE dayofweek(date_) NOT BETWEEN 1 AND 5
), weekdays_3 AS (SELECT views FROM weekdays WHERE views <= 3
), weekends_3 AS (SELECT views FROM weekends WHERE views <= 3)"""
_DAY_TYPES = {
    "weekdays": "views_weekdays_total",
    "weekends": "views_weekends_total",
    "weekdays_3": "views_weekdays_3",
    "weekends_3": "views_weekends_3",
}


@query(
    f"WITH {_DAILY_SQL}\n"
    + "\nUNION ALL ".join(f(s, t, "views") for s, t in _DAY_TYPES.items() for f in (_moments_sql, _histogram_sql))
)
def profile_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    daily = settled(events.groupBy("user_id", F.to_date("ts").alias("date_")).agg(F.count("*").alias("views")))
    return _rounded(ops.profile_by_day_type(daily, "views", "date_", "views", 3))


@query(
    f"{_moments_sql('part', 'size', 'p_size')}\nUNION ALL {_histogram_sql('part', 'size', 'p_size')}\n"
    f"UNION ALL {_moments_sql('supplier', 'balance', 's_acctbal')}"
)
def profile_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of two tables, appended to a metrics table and read back."""
    target = f"{shared_dir(spark)}/metrics"
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    append_metrics(ops.profile(part, "p_size", "size"), target)
    append_metrics(ops.profile_column(supplier, "s_acctbal", "balance"), target)
    return _rounded(spark.read.parquet(target))


@query(
    """
WITH agent AS (SELECT *, nullif(event_id % 10, 3) AS kind FROM events)
SELECT 'kind' AS field, (SELECT count(*) FROM (SELECT DISTINCT kind FROM agent)) AS count
UNION ALL SELECT 'event_type', (SELECT count(*) FROM (SELECT DISTINCT event_type FROM agent))
UNION ALL SELECT 'user_id', (SELECT count(*) FROM (SELECT DISTINCT user_id FROM agent))
UNION ALL SELECT 'props', (SELECT count(*) FROM (SELECT DISTINCT props FROM agent))"""
)
def distinct_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.nullif(F.col("event_id") % 10, F.lit(3))
    events = table(spark, sf_dir, "events").withColumn("kind", kind)
    return count_distinct_per_column(events, ["kind", "event_type", "user_id", "props"])


_WEEK = "strftime(date_trunc('week', ts), '%Y-%m-%d')"


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week")
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), week, "user_id", "event_type", "value")


@query(f"""
SELECT {_WEEK} AS week, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS deviation, min(value) AS low,
       max(value) AS high, true AS median_fits FROM events GROUP BY 1""")
def profile_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of weeks from what was kept of each day; the median's rank is held against the values."""
    root, events = shared_dir(spark), _by_day(spark, sf_dir)
    append_run(spans.daily_moments(events, "day", "value"), root, "days", "all")
    days = read_runs(spark, root, "days").withColumn("week", F.date_format(F.date_trunc("week", "day"), "yyyy-MM-dd"))
    weeks = spans.merged_moments(days, ["week"])
    ranks = events.join(weeks.select("week", "`q0.5`"), "week").groupBy("week").agg(
        (F.count(F.when(F.col("value") < F.col("`q0.5`"), 1)) / F.count("value")).alias("under"),
        (F.count(F.when(F.col("value") <= F.col("`q0.5`"), 1)) / F.count("value")).alias("upto"),
    )
    fits = (F.col("under") <= 0.5 + 0.005) & (F.col("upto") >= 0.5 - 0.005)
    return weeks.join(ranks, "week").select(
        "week", "n", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"), "low", "high", fits.alias("median_fits")
    )


@query(f"SELECT {_WEEK} AS week, event_type AS bin, count(*) AS n FROM events GROUP BY ALL")
def histogram_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of weeks from bins of days."""
    days = settled(spans.daily_bins(_by_day(spark, sf_dir), "day", "event_type"))
    week = F.date_format(F.date_trunc("week", "day"), "yyyy-MM-dd")
    return spans.merged_bins(days.withColumn("week", week), ["week"]).select("week", "bin", "n")


@query(f"SELECT {_WEEK} AS week, count(DISTINCT user_id) AS distinct_ids FROM events GROUP BY 1")
def distinct_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of weeks from bitmaps of days."""
    days = settled(spans.daily_ids(_by_day(spark, sf_dir), "day", "user_id"))
    week = F.date_format(F.date_trunc("week", "day"), "yyyy-MM-dd")
    return spans.distinct_ids(days.withColumn("week", week), ["week"]).select("week", "distinct_ids")


@query(f"{_moments_sql('part', 'size', 'p_size')}\nUNION ALL {_moments_sql('supplier', 'balance', 's_acctbal')}")
def profile_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics appended in runs, one of which is made twice and counts once."""
    root = shared_dir(spark)
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    append_run(ops.profile_column(part, "p_size", "size"), root, "metrics", "size")
    for rows in (supplier.limit(3), supplier):
        append_run(ops.profile_column(rows, "s_acctbal", "balance"), root, "metrics", "balance")
    return _rounded(read_runs(spark, root, "metrics"))


@query(None)
def iforest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How easily events are told apart by value, time of day and length of what they carry."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", (F.hour("ts") + F.minute("ts") / 60.0).alias("hour"), F.length("props").alias("length")
    )
    return isolation.anomaly_scores(events, ["value", "hour", "length"])
