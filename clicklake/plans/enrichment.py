"""Places and local time of events by address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.operators import geo
from clicklake.plans import query
from clicklake.plans.inputs import GEO_SQL, events_with_any_ip, events_with_ip, geo_networks, geo_ranges, nested_ranges

FIELDS = ["countryName", "region", "city", "postalCode", "continent"]
_LOOKUP_SQL = f"WITH {GEO_SQL} SELECT event_id, machine_ip, country, city, zone AS timezone FROM located"


def _lookup(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    located = geo.range_lookup(events_with_ip(spark, sf_dir), "machine_ip", geo_ranges(spark, sf_dir), **options)
    return located.select(
        "event_id", "machine_ip", F.col("geo.countryName").alias("country"), "geo.city", "geo.timezone"
    )


@query(_LOOKUP_SQL)
def geo_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir)


@query(_LOOKUP_SQL)
def geo_range_join_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way a range table takes that is too large to broadcast."""
    return _lookup(spark, sf_dir, max_broadcast_rows=0)


_NESTED_SQL = f"""WITH {GEO_SQL}, nested AS (
  SELECT lo, hi, country FROM ranges UNION ALL SELECT lo + 100000, lo + 400000, country || ' inner' FROM ranges
  UNION ALL SELECT lo + 550000, lo + 650000, country || ' edge' FROM ranges
)
SELECT event_id, machine_ip, min_by(country, hi - lo) AS country
FROM ip LEFT JOIN nested ON ip_number BETWEEN lo AND hi GROUP BY event_id, machine_ip"""


def _nested(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    located = geo.range_lookup(events_with_ip(spark, sf_dir), "machine_ip", nested_ranges(spark, sf_dir), **options)
    return located.select("event_id", "machine_ip", F.col("geo.countryName").alias("country"))


@query(_NESTED_SQL)
def geo_nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping ranges: the narrowest one counts."""
    return _nested(spark, sf_dir)


@query(_NESTED_SQL)
def geo_nested_ranges_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the way that broadcasts nothing."""
    return _nested(spark, sf_dir, max_broadcast_rows=0)


@query("""
WITH ip AS (SELECT event_id, event_id % 7 AS kind, user_id % 256 * 65536 + event_id % 256 * 256 + event_id % 251 AS v4,
                   user_id % 64 AS third, event_id % 65536 AS fourth FROM events),
n AS (SELECT n_nationkey AS k, n_name AS name FROM nation),
met AS (
  SELECT event_id, 13 AS bits, name AS country FROM ip JOIN n ON kind < 2 AND v4 // 524288 = k
  UNION ALL SELECT event_id, 18, name || ' inner' FROM ip JOIN n ON kind < 2 AND v4 // 16384 = (k * 8 + 1) * 4 + 1
  UNION ALL SELECT event_id, 47, name FROM ip JOIN n ON kind IN (2, 3, 4) AND third // 2 = k
  UNION ALL SELECT event_id, 50, name || ' inner' FROM ip JOIN n ON kind IN (2, 3, 4) AND third = k * 2 AND fourth // 16384 = 1)
SELECT ip.event_id, max_by(country, bits) AS country FROM ip LEFT JOIN met USING (event_id) GROUP BY ip.event_id
""")
def geo_prefix_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest network of addresses of both families."""
    prefixes = geo.prefix_table(geo_networks(spark, sf_dir))
    located = geo.prefix_lookup(events_with_any_ip(spark, sf_dir), "machine_ip", prefixes)
    return located.select("event_id", F.col("geo.countryName").alias("country"))


def _with_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.range_lookup(events_with_ip(spark, sf_dir), "machine_ip", geo_ranges(spark, sf_dir))


@query(
    f"""WITH {GEO_SQL} SELECT event_id, country IS NOT NULL AS located, country, region FROM located"""
)
def geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.geo_json(_with_geo(spark, sf_dir)).select(
        "event_id",
        (F.col("geo_json") != "").alias("located"),
        F.get_json_object("geo_json", "$.countryName").alias("country"),
        F.get_json_object("geo_json", "$.region").alias("region"),
    )


@query(
    f"""WITH {GEO_SQL} SELECT strftime(ts, '%Y-%m-%d') AS date_, user_id,
       count(DISTINCT coalesce(country || '/' || region, '')) AS places FROM located GROUP BY 1, 2"""
)
def geo_mobility(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _with_geo(spark, sf_dir).withColumn("date_", F.date_format("ts", "yyyy-MM-dd"))
    return geo.geo_mobility(events, "date_", "user_id")


@query(
    f"""WITH {GEO_SQL} SELECT user_id, country AS "countryName", region, city, NULL::VARCHAR AS "postalCode",
       region AS continent, count(*) AS count FROM located GROUP BY ALL"""
)
def geo_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.geo_breakdown(_with_geo(spark, sf_dir), FIELDS, by=["user_id"])


@query(
    f"""WITH {GEO_SQL} SELECT event_id, ts, coalesce(zone, 'America/New_York') AS timezone,
       CASE WHEN zone IS NULL THEN ts ELSE timezone(zone, timezone('UTC', ts)) END AS client_time FROM located"""
)
def client_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = geo.client_time(events_with_ip(spark, sf_dir), "ts", "machine_ip", geo_ranges(spark, sf_dir))
    return local.select("event_id", "ts", "timezone", "client_time")


@query(
    f"""WITH {GEO_SQL} SELECT event_id, CASE WHEN zone IS NULL OR zone = 'Asia/Tokyo' THEN 'America/New_York' ELSE zone END AS timezone,
       CASE WHEN zone IS NULL OR zone = 'Asia/Tokyo' THEN ts ELSE timezone(zone, timezone('UTC', ts)) END AS client_time
       FROM located"""
)
def client_time_bad_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of one region name a zone that does not exist."""
    zone = F.col("geo.timezone")
    bad = F.when(zone == "Asia/Tokyo", F.lit("Nowhere/Atall")).otherwise(zone)
    ranges = geo_ranges(spark, sf_dir).withColumn("geo", F.col("geo").withField("timezone", bad))
    local = geo.client_time(events_with_ip(spark, sf_dir), "ts", "machine_ip", ranges)
    return local.select("event_id", "timezone", "client_time")
