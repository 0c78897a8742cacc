"""Joins, aggregations and the reports made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.functions.numbers import floor_mod
from clicklake.operators import aggregates, joins, outliers
from clicklake.operators.projection import values_table
from clicklake.operators.templates import fill_templates
from clicklake.plans import query
from clicklake.plans.inputs import table
from clicklake.sources.files import settled

_BY_CUSTOMER = [("o_custkey", "c_custkey")]


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    # Whole numbers with nulls differ in how frames outside Spark show them.
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _orders_customer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")


@query(
    """
SELECT s_suppkey, s_name, s_nationkey, n_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").drop("s_acctbal")
    nation = table(spark, sf_dir, "nation").drop("n_regionkey")
    return joins.inner_join(supplier, joins.broadcast_if_small(nation, 1000), [("s_nationkey", "n_nationkey")])


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey::VARCHAR AS c_custkey, c_name FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""
)
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _orders_customer(spark, sf_dir)
    solvent = customer.where("c_acctbal > 0").select("c_custkey", "c_name")
    joined = joins.left_join(orders.select("o_orderkey", "o_custkey", "o_totalprice"), solvent, _BY_CUSTOMER)
    return _as_text(joined, "c_custkey")


@query(
    """
SELECT c_custkey, c_name, o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey FROM customer
LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) ON c_custkey = o_custkey"""
)
def join_left_hot_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _orders_customer(spark, sf_dir)
    dear = orders.where("o_totalprice > 300000").select("o_orderkey", "o_custkey")
    customer = customer.select("c_custkey", "c_name")
    joined = joins.left_join(customer, dear, [("c_custkey", "o_custkey")], hot_right=True)
    return _as_text(joined, "o_orderkey", "o_custkey")


@query(
    """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, c_custkey, c_name
FROM (SELECT * FROM orders WHERE o_totalprice > 300000)
RIGHT JOIN customer ON o_custkey = c_custkey"""
)
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _orders_customer(spark, sf_dir)
    dear = orders.where("o_totalprice > 300000").select("o_orderkey", "o_custkey")
    joined = joins.right_join(dear, customer.select("c_custkey", "c_name"), _BY_CUSTOMER, hot_left=True)
    return _as_text(joined, "o_orderkey", "o_custkey")


@query(
    """
SELECT code::VARCHAR AS code, c_name, p_partkey::VARCHAR AS p_partkey, p_name
FROM (SELECT c_custkey * 2 AS code, c_name FROM customer)
FULL JOIN part ON code = p_partkey"""
)
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("code"), "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return _as_text(joins.full_join(customer, part, [("code", "p_partkey")]), "code", "p_partkey")


@query(
    """
SELECT * FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)"""
)
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _orders_customer(spark, sf_dir)
    return joins.semi_join(customer, orders.where("o_totalprice > 450000"), [("c_custkey", "o_custkey")])


@query(
    """
SELECT * FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)"""
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _orders_customer(spark, sf_dir)
    return joins.anti_join(customer, orders.where("o_totalprice > 450000"), [("c_custkey", "o_custkey")])


@query(
    """
SELECT o_custkey, o_orderstatus, o_orderkey, n FROM orders
JOIN (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) USING (o_custkey, o_orderstatus)"""
)
def join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    keys = ["o_custkey", "o_orderstatus"]
    return joins.join_using(orders, orders.groupBy(*keys).agg(F.count("*").alias("n")), keys)


_TITLES = [("click", "Clicking around"), ("view", "A closer look"), ("purchase", "Off to the till")]


@query(
    """
WITH titles(event_type, title) AS (
  VALUES ('click', 'Clicking around'), ('view', 'A closer look'), ('purchase', 'Off to the till')
)
SELECT strftime(ts, '%Y-%m-%d') AS date_, title, count(*) AS page_views
FROM events JOIN titles USING (event_type) GROUP BY 1, 2"""
)
def join_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the titles of a literal dimension table."""
    titles = values_table(spark, _TITLES, "event_type string, title string")
    events = table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("date_"))
    # A few event types hold all rows: without a hint, each would be sorted by one task.
    return joins.join_using(events, joins.broadcast_if_small(titles), ["event_type"]).groupBy("date_", "title").agg(
        F.count("*").alias("page_views")
    )


_OUTLIER_SQL = """
WITH views AS (
  SELECT event_type, strftime(ts, '%Y-%m-%d') AS date_, count(*) AS page_views FROM events GROUP BY 1, 2
), stats AS (
  SELECT event_type, stddev_samp(page_views) AS stddev, {limit} AS upper_limit FROM views GROUP BY 1
)
SELECT event_type, date_, page_views, round(stddev, 6) AS stddev, round(upper_limit, 6) AS upper_limit,
       page_views > upper_limit AS is_outlier
FROM views JOIN stats USING (event_type) WHERE page_views > upper_limit"""


def _outliers(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("date_", F.date_format("ts", "yyyy-MM-dd"))
    found = outliers.sigma_outliers(events, "date_", "event_type", **options)
    return found.withColumns({c: F.round(c, 6) for c in ("stddev", "upper_limit")})


@query(_OUTLIER_SQL.format(limit="3 * stddev_samp(page_views)"))
def outlier_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outliers(spark, sf_dir)


@query(_OUTLIER_SQL.format(limit="avg(page_views) + 2 * stddev_samp(page_views)"))
def outlier_sigma_centered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outliers(spark, sf_dir, k=2.0, center=True)


_GROWTH_SQL = """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) - DATE '2024-01-06' AS datediff, count(*) AS n FROM events GROUP BY 1, 2
), lagged AS (
  SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY datediff) AS prev FROM daily
)
SELECT CAST(datediff AS INTEGER) AS datediff, round(avg(coalesce((n - prev)::DOUBLE / prev, 0.0)), 6) AS avg_pct
FROM lagged WHERE datediff >= 0 GROUP BY 1"""


def _growth(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-06").cast("date"))
    daily = table(spark, sf_dir, "events").groupBy("user_id", day.alias("datediff")).agg(F.count("*").alias("n"))
    curve = outliers.growth_curve(settled(daily), "user_id", "datediff", "n", **options)
    return curve.withColumn("avg_pct", F.round("avg_pct", 6))


@query(_GROWTH_SQL)
def lag_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growth(spark, sf_dir)


@query(_GROWTH_SQL)
def lag_growth_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growth(spark, sf_dir, hot_rows=5)



def _disclosures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to four key/value rows per customer; some values are empty."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    pairs = F.array(
        F.struct(F.lit("{name}").alias("key"), F.col("c_name").alias("value")),
        F.struct(F.lit("{segment}").alias("key"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("value")),
        F.struct(F.lit("{nation}").alias("key"), F.col("n_name").alias("value")),
        F.struct(F.lit("").alias("key"), F.lit("unused").alias("value")),
    )
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        "c_nationkey",
        F.lit("Dear {name}, {segment} in {nation}: {name}").alias("template"),
        F.posexplode(F.slice(pairs, 1, (F.col("c_custkey") % 4 + 1).cast("int"))),
    )
    return rows.select(
        "c_custkey", "c_nationkey", "template", (F.col("pos") + 1).alias("rownum"), "col.key", "col.value"
    )


_TEMPLATE_SQL = """
WITH named AS (
  SELECT c_custkey, c_custkey % 4 AS extra, c_mktsegment, n_name,
         replace('Dear {{name}}, {{segment}} in {{nation}}: {{name}}', '{{name}}', c_name) AS filled
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), second AS (
  SELECT *, CASE WHEN extra >= 1 AND c_mktsegment <> 'BUILDING' THEN replace(filled, '{{segment}}', c_mktsegment)
            ELSE filled END AS filled2 FROM named
)
SELECT DISTINCT c_custkey, {result} AS filled FROM second"""
_IDS = ["c_custkey", "c_nationkey"]


def _filled(spark: SparkSession, sf_dir: str, steps: int) -> DataFrame:
    rows = _disclosures(spark, sf_dir)
    return fill_templates(rows, _IDS, ["c_custkey"], "template", "rownum", "key", "value", steps)


@query(_TEMPLATE_SQL.format(result="filled2"))
def template_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir, 2)


@query(_TEMPLATE_SQL.format(result="CASE WHEN extra >= 2 THEN replace(filled2, '{nation}', n_name) ELSE filled2 END"))
def template_fill_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir, 4)


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_values(table(spark, sf_dir, "events"), "user_id", "event_type")


@query(
    """
SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts, round(avg(value), 6) AS mean FROM events GROUP BY 1"""
)
def group_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "events").groupBy("event_type")
    mean = F.round(F.avg("value"), 6)
    return grouped.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), mean.alias("mean"))


@query(
    """
SELECT user_id % 4 AS mod, count(CASE WHEN user_id % 4 = 0 THEN 1 END) AS "0",
       count(CASE WHEN user_id % 4 = 1 THEN 1 END) AS "1", count(CASE WHEN user_id % 4 = 2 THEN 1 END) AS "2",
       count(CASE WHEN user_id % 4 = 3 THEN 1 END) AS "3"
FROM events GROUP BY 1"""
)
def pivot_mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(floor_mod(F.col("user_id"), F.lit(4)).alias("mod"))
    return aggregates.pivot_counts(events, "mod", [0, 1, 2, 3]).orderBy("mod")
