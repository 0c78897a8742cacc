"""Visits, agents and registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.functions import text
from clicklake.functions.user_agent import app_fallback, with_agent_json
from clicklake.operators import agent_rules, visits as ops
from clicklake.plans import query
from clicklake.plans.inputs import (
    AGENT_SQL, APP, CATEGORY_SQL, FAMILY_SQL, SITE, VISITS_SQL, events_with_agent, events_with_family, table, visits,
)
from clicklake.sources.files import read_csv, shared_dir, write_csv
from clicklake.sources.schemas import REGISTRATIONS

_HAS_SOURCE = """coalesce(list_contains(
         [split_part(x, '=', 1) FOR x IN str_split(replace(trim(url_params), '?', ''), '&')], 'source'), false)"""
_FLAT = "device_class, agent_class, os_name, os_version, agent_name, agent_version, device_brand, device_name"


@query(f"WITH {VISITS_SQL}, {CATEGORY_SQL.format(source='visits')} SELECT event_id, page_category FROM categorised")
def page_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.with_page_category(visits(spark, sf_dir), "referrer", SITE).select("event_id", "page_category")


@query(f"WITH {VISITS_SQL} SELECT event_id, {_HAS_SOURCE} AS has_source FROM visits")
def has_query_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = text.has_query_param(F.col("url_params"), "source").alias("has_source")
    return visits(spark, sf_dir).select("event_id", flag)


@query(
    f"""WITH {VISITS_SQL}, {CATEGORY_SQL.format(source="visits")}
SELECT page_category, CAST({_HAS_SOURCE} AS INTEGER) AS has_source_param, count(*) AS count
FROM categorised WHERE ts IS NOT NULL AND contains(referrer, 'example.com') GROUP BY 1, 2"""
)
def count_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.source_counts(visits(spark, sf_dir), "ts", "referrer", "url_params", SITE)


_BACK_SQL = f"""WITH {VISITS_SQL}, lagged AS (
  SELECT *, split_part(session_cookie, '.', 1) AS session_key,
         lag(referrer) OVER (PARTITION BY split_part(session_cookie, '.', 1) ORDER BY ts, event_id)
           AS previous_referrer
  FROM visits WHERE ts IS NOT NULL AND contains(referrer, 'example.com')
)
SELECT ts, event_id, session_key, referrer, url, url_params, previous_referrer,
       CASE WHEN contains(url, previous_referrer) THEN 1 ELSE 0 END AS is_back,
       CAST({_HAS_SOURCE} AS INTEGER) AS has_source_param
FROM lagged"""


def _back(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return ops.back_navigation(
        visits(spark, sf_dir), "session_cookie", "ts", "event_id", "referrer", "url", "url_params", SITE, **options
    )


@query(_BACK_SQL)
def back_navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _back(spark, sf_dir)


@query(_BACK_SQL)
def back_navigation_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _back(spark, sf_dir, hot_rows=10)



@query(
    r"""
SELECT page_id, coalesce(nullif(regexp_extract(url, '^https?://([^/]+\.com)/', 1), ''), substr(url, 1, 16)) AS referrer_
FROM pages"""
)
def referrer_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.nullif(F.regexp_extract("url", r"^https?://([^/]+\.com)/", 1), F.lit(""))
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.coalesce(domain, F.substring("url", 1, 16)).alias("referrer_"))


@query(f"WITH {AGENT_SQL} SELECT event_id, {_FLAT} FROM agent")
def ua_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = ops.enrich_agents(events_with_agent(spark, sf_dir), "user_agent", APP)
    return enriched.select("event_id", *_FLAT.split(", "))


_MAJOR = "split_part({0}, '.', 1)"


@query(f"""WITH {FAMILY_SQL} SELECT *, {_MAJOR.format("agent_version")} AS agent_major, engine || ' ' || {_MAJOR.format("engine_version")} AS engine_name_major,
       os_name || ' ' || os_version AS os_name_version FROM known""")
def ua_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families that the rule table tells apart, with all kinds of attributes."""
    found = agent_rules.with_agent_attributes(events_with_family(spark, sf_dir), "user_agent", APP, agent_rules.rule_table(spark))
    columns = {
        "agent_name": "AgentName", "agent_version": "AgentVersion", "engine": "LayoutEngineName", "engine_version": "LayoutEngineVersion",
        "os_name": "OperatingSystemName", "os_class": "OperatingSystemClass", "os_version": "OperatingSystemVersion", "cpu": "DeviceCpu",
        "security": "AgentSecurity", "language": "AgentLanguageCode", "device_version": "DeviceVersion", "agent_major": "AgentVersionMajor",
        "engine_name_major": "LayoutEngineNameVersionMajor", "os_name_version": "OperatingSystemNameVersion",
    }
    return found.select("event_id", *[F.col(f"agent.{of}").alias(name) for name, of in columns.items()])


@query(
    f"""WITH {AGENT_SQL} SELECT event_id, CASE WHEN event_id % 10 IN (6, 7) THEN os_name END AS os_name,
       CASE WHEN event_id % 10 IN (6, 7) THEN os_version END AS os_version,
       CASE WHEN event_id % 10 = 6 THEN agent_name END AS agent_name,
       CASE WHEN event_id % 10 = 6 THEN agent_version END AS agent_version
FROM agent"""
)
def ua_app_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    agents = events_with_agent(spark, sf_dir).withColumn("app", app_fallback(F.col("user_agent"), APP))
    return agents.select("event_id", "app.*")


@query(
    f"""WITH {AGENT_SQL} SELECT event_id, user_agent <> '' AS parsed, os_name AS os, agent_version AS version
FROM agent"""
)
def ua_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    agents = with_agent_json(events_with_agent(spark, sf_dir), "user_agent", APP, "json")
    return agents.select(
        "event_id",
        F.col("json").isNotNull().alias("parsed"),
        text.json_field(F.col("json"), "$.OperatingSystemName").alias("os"),
        text.json_field(F.col("json"), "$.AgentVersion").alias("version"),
    )


@query(f"WITH {AGENT_SQL} SELECT DISTINCT replace(user_agent, '\"', '') AS user_agent, {_FLAT} FROM agent")
def distinct_ua(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.agent_inventory(events_with_agent(spark, sf_dir), "user_agent", APP)


@query(
    f"""WITH {AGENT_SQL}
SELECT user_id, user_id || '@mail' || event_id AS email, 'mail' || event_id AS email_domain,
       strftime(ts, '%Y-%m-%d') AS registration_date, CAST(hour(ts) AS INTEGER) AS registration_hour,
       strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS confirmation_date, CAST(event_id % 2 AS INTEGER) AS is_confirmed,
       event_id % 3 AS is_gplus, event_type AS page_type, device_class, os_name, os_version, agent_name,
       agent_version, device_brand, device_name, event_id::VARCHAR AS client_id
FROM agent WHERE agent_class <> 'Browser Webview'"""
)
def registration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a CSV file of registrations."""
    event = F.col("event_id").cast("string")
    domain = F.concat(F.lit("mail"), event)
    registrations = events_with_agent(spark, sf_dir).select(
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("@"), domain).alias("email"),
        domain.alias("email_domain"),
        F.to_date("ts").alias("registration_date"),
        F.hour("ts").alias("registration_hour"),
        F.date_add(F.to_date("ts"), 1).alias("confirmation_date"),
        (F.col("event_id") % 2).cast("int").alias("is_confirmed"),
        "user_agent",
        (F.col("event_id") % 3).alias("is_gplus"),
        F.col("event_type").alias("page_type"),
        event.alias("client_id"),
    )
    path = shared_dir(spark)
    write_csv(registrations, path)
    report = ops.registration_report(read_csv(spark, path, REGISTRATIONS), APP)
    return report.withColumns({c: F.col(c).cast("string") for c in ("registration_date", "confirmation_date")})
