"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.functions import text, times
from clicklake.functions.numbers import floor_mod
from clicklake.operators import projection
from clicklake.plans import query
from clicklake.plans.inputs import table


@query(
    """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       CAST(json_extract_string(props, '$.k') AS BIGINT) + 10 AS new_k,
       nullif(split_part(event_type || '/' || user_id, '/', 2), '') AS second_level
FROM events"""
)
def project_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", "event_type", F.col("user_id").cast("string"))
    columns = {
        "k": text.json_field(F.col("props"), "$.k"),
        "new_k": text.json_number_plus(F.col("props"), "$.k", 10),
        "second_level": text.path_level(path, 1),
    }
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return projection.project_map(events, columns, drop=["user_id", "event_type", "props"])


@query(
    """
SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS missing, NULL::VARCHAR AS of_null
FROM events"""
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.json_field(F.col("props"), "$.k").alias("k"),
        text.json_field(F.col("props"), "$.missing").alias("missing"),
        text.json_field(F.nullif(F.col("props"), F.col("props")), "$.k").alias("of_null"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").withColumn("parsed", F.from_json("props", "k int"))
    return parsed.select("event_id", "parsed.k")


_CASE = "case when value >= 5 and event_type = 'click' then 'a' else 'b' end"


@query(f"SELECT event_id, {_CASE} AS dyn FROM events")
def dyn_case_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.case_column(table(spark, sf_dir, "events"), "dyn", _CASE).select("event_id", "dyn")


@query(
    """
SELECT value, props, CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       TRY_CAST(event_type AS INTEGER) AS event_type, strftime(ts, '%Y-%m-%d') AS day
FROM events"""
)
def cast_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", times.parse_date(F.date_format("ts", "yyyy-MM-dd")))
    schema = "event_id int, user_id string, event_type int, day string"
    return projection.cast_schema(events.drop("ts"), schema)


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_, strftime(ts, '%Y-%m-%d %H') AS hour_, strftime(ts, '%M') AS minute_,
       CAST(dayofweek(ts) BETWEEN 1 AND 5 AS INTEGER) AS is_weekday
FROM events"""
)
def time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.day(ts).alias("date_"),
        times.day_hour(ts).alias("hour_"),
        times.minute(ts).alias("minute_"),
        times.is_weekday(ts).alias("is_weekday"),
    )


@query(r"""SELECT doc_id, replace(replace(text, '"', ''), '''', '') AS bare FROM documents""")
def scalar_qtrim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_quotes(F.col("text")).alias("bare"))


@query(
    """
SELECT doc_id, length(text) AS chars FROM documents
WHERE text IS NOT NULL AND contains(lower(text), 'the') OR starts_with(source, 'src1')"""
)
def filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.col("text").isNotNull() & F.lower("text").contains("the") | F.col("source").startswith("src1")
    documents = table(spark, sf_dir, "documents").where(wanted)
    return documents.select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query(
    """
SELECT DISTINCT c_nationkey FROM customer
WHERE nullif(c_mktsegment, 'BUILDING') IS NOT DISTINCT FROM NULL"""
)
def filter_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    customer = table(spark, sf_dir, "customer").where(segment.eqNullSafe(F.lit(None)))
    return customer.select("c_nationkey").distinct()


@query("SELECT * FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')")
def filter_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"))


@query(
    """
SELECT event_id, ((event_id - 500) % 4 + 4) % 4 AS plus, ((event_id - 500) % -4 - 4) % -4 AS minus FROM events"""
)
def scalar_floor_mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.col("event_id") - 500
    return table(spark, sf_dir, "events").select(
        "event_id", floor_mod(shifted, F.lit(4)).alias("plus"), floor_mod(shifted, F.lit(-4)).alias("minus")
    )
