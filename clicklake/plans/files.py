"""File sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake import jobs
from clicklake.functions.times import parse_second
from clicklake.operators.aggregates import latest_by_key
from clicklake.plans import query
from clicklake.plans.inputs import table
from clicklake.sources import files
from clicklake.sources.schemas import log_layout


@query("SELECT * FROM orders")
def src_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), files.shared_dir(spark)
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


@query("SELECT o_custkey, o_orderdate, o_orderkey FROM orders WHERE o_custkey IS NOT NULL")
def sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted by user and time, as bzip2 CSV."""
    orders, path = table(spark, sf_dir, "orders"), files.shared_dir(spark)
    timed = orders.where("o_custkey is not null").select("o_custkey", "o_orderdate", "o_orderkey")
    files.write_csv(files.sorted_export(timed, ["o_custkey"], ["o_orderdate"]), path, compression="bzip2")
    return files.read_csv(spark, path, timed.schema)


@query(
    """
SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"""
)
def src_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_dir(spark)
    files.write_csv(table(spark, sf_dir, "customer"), path)
    return files.read_csv_inferred(spark, path)


@query("SELECT n_name AS user_agent, n_nationkey::VARCHAR AS code FROM nation")
def src_csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_dir(spark)
    files.write_csv(table(spark, sf_dir, "nation"), path, header=False)
    return files.read_positional(spark, path, {"user_agent": 1, "code": 0})


def _log_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as headerless logs of three eras, read by their layouts."""
    orders, root = table(spark, sf_dir, "orders"), files.shared_dir(spark)
    year = F.year("o_orderdate")
    eras = {2014: year < 1998, 2016: year.between(1998, 1999), 2018: year >= 2000}
    parts = []
    for log_year, era in eras.items():
        layout = log_layout(log_year)
        values = {
            layout["user_id"]: F.col("o_custkey").cast("string"),
            layout["email"]: F.concat(F.lit("u@"), F.col("o_orderpriority")),
            layout["ts"]: F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        }
        line = [values.get(i, F.lit("x")).alias(f"c{i}") for i in range(max(values) + 1)]
        path = f"{root}/log_{log_year}"
        files.write_csv(orders.where(era).select(line), path, header=False, sep="\t")
        parts.append(files.read_positional(spark, f"{path}*", layout, sep="\t").where("user_id is not null"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LOG_SQL = "SELECT o_custkey::VARCHAR AS user_id, 'u@' || o_orderpriority AS email"


@query(f"{_LOG_SQL}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts FROM orders")
def src_tsv_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log_years(spark, sf_dir)


@query(f"{_LOG_SQL}, max(o_orderdate) AS ts FROM orders GROUP BY 1, 2")
def latest_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _log_years(spark, sf_dir).withColumn("ts", parse_second(F.col("ts")))
    return latest_by_key(logs, ["user_id", "email"], "ts")


@query("SELECT * FROM events")
def src_json_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzipped JSON lines in a folder per day."""
    events, path = table(spark, sf_dir, "events"), files.shared_dir(spark)
    by_day = events.withColumns({"month": F.date_format("ts", "yyyy-MM"), "day": F.dayofmonth("ts")})
    files.write_json(by_day, path, partition_by=["month", "day"])
    return files.read_json_tree(spark, path, events.schema)


@query("SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier")
def src_json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_dir(spark)
    files.write_json(table(spark, sf_dir, "supplier"), path)
    return files.read_json_inferred(spark, f"{path}/*.gz")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def src_parquet_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.read_parquet(spark, f"{sf_dir}/lineitem*.parquet")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


def _weekly_hours(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {"date_": F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"), "hour": F.date_format("ts", "HH")}
    )


_HOURS_SQL = """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS date_, strftime(ts, '%H') AS hour, {rest} FROM events"""


@query(_HOURS_SQL.format(rest="event_id, value"))
def src_parquet_leafs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours, each a partition folder named by the caller."""
    path = files.shared_dir(spark)
    hourly = _weekly_hours(table(spark, sf_dir, "events")).select("event_id", "value", "date_", "hour")
    files.write_parquet(hourly, path, partition_by=["date_", "hour"])
    read = files.read_partition_leafs(spark, path, [f"date_=*/hour={hour:02d}" for hour in range(24)])
    # Partition values are read back by their looks: dates and numbers.
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    return read.select(F.col("date_").cast("string"), hour.alias("hour"), "event_id", "value")


@query(_HOURS_SQL.format(rest="count(*) AS n") + " GROUP BY 1, 2")
def tbl_partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hourly table, counted through SQL text."""
    path = files.shared_dir(spark)
    name = f"hourly_{path.rsplit('-', 1)[-1]}"
    files.write_table(_weekly_hours(table(spark, sf_dir, "events")), name, ["date_", "hour"], path)
    return spark.sql(f"SELECT date_, hour, count(1) AS n FROM {name} GROUP BY date_, hour")


@query(_HOURS_SQL.format(rest="event_id::VARCHAR AS page_key, CASE WHEN hour(ts) = 7 THEN 'again' ELSE event_type END AS page_type"))
def hourly_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts of hourly folders as a table, of which one hour of each week is then replaced."""
    root = files.shared_dir(spark)
    events = _weekly_hours(table(spark, sf_dir, "events"))
    posts = events.select(F.col("event_id").cast("string").alias("page_key"), F.col("event_type").alias("page_type"), "date_", "hour")
    files.write_json(posts, f"{root}/first", partition_by=["date_", "hour"])
    files.write_json(posts.where("hour = '07'").withColumn("page_type", F.lit("again")), f"{root}/second", partition_by=["date_", "hour"])
    name = f"replaced_{root.rsplit('-', 1)[-1]}"
    weeks = [r[0] for r in events.select("date_").distinct().collect()]
    for part, hours in (("first", range(24)), ("second", [7])):
        folders = {(week, f"{hour:02d}"): f"{root}/{part}/date_={week}/hour={hour:02d}" for week in weeks for hour in hours}
        jobs.hourly_table(spark, folders, name, f"{root}/table")
    found = spark.table(name).select("page_key", "page_type", "date_", "hour")
    # The files stay; the name has been resolved.
    path = f"{root}/table"
    spark.sql(f"DROP TABLE {name}")
    schema = "page_key string, page_type string, date_ string, hour string"
    return spark.read.schema(schema).parquet(path).select(found.columns)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def sink_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder written twice, each time as one file: the second time counts."""
    path, nation = files.shared_dir(spark), table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    files.write_csv(nation.drop("n_regionkey"), path, single_file=True)
    files.write_csv(nation.where("n_regionkey = 1").drop("n_regionkey"), path, single_file=True)
    return files.read_csv(spark, path, nation.drop("n_regionkey").schema)


@query("SELECT o_custkey, o_orderkey, o_orderdate AS ts FROM orders")
def src_csv_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in ordinary text, as logs have them, by an explicit schema."""
    path, orders = files.shared_dir(spark), table(spark, sf_dir, "orders")
    plain = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ts")
    files.write_csv(orders.select("o_custkey", "o_orderkey", plain), path)
    return files.read_csv(spark, path, "o_custkey bigint, o_orderkey bigint, ts timestamp_ntz")


@query("SELECT event_id, event_type, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS half FROM events")
def union_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    halves = {"am": F.hour("ts") < 12, "pm": F.hour("ts") >= 12}
    am, pm = [files.with_constants(events.where(h), {"half": F.lit(name)}) for name, h in halves.items()]
    return am.unionByName(pm).select("event_id", "event_type", "half")


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, path = table(spark, sf_dir, "part"), files.shared_dir(spark)
    part = part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    files.write_csv(part, path)
    return files.read_csv(spark, path, part.schema)


@query("SELECT * FROM events")
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_dir(spark)
    files.write_parquet(table(spark, sf_dir, "events"), path)
    return files.read_parquet(spark, path)


@query("SELECT o_custkey FROM orders")
def layout_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of orders, laid out by year."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return files.spread_by(orders.select("o_custkey", "year"), "year").select("o_custkey")
