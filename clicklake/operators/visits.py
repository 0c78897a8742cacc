"""Reports on page visits: sources, back navigation, agents, registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake.functions.text import has_query_param, session_key, strip_quotes, with_page_category
from clicklake.functions.user_agent import AppNames, agent_class, with_agent_columns
from clicklake.operators.aggregates import count_by, distinct_values
from clicklake.operators.skew import HOT_ROWS
from clicklake.operators.windows import lag_by_key


def site_visits(df: DataFrame, ts: str, referrer: str, site: str) -> DataFrame:
    """Timed visits that came from a page of the site."""
    return df.where(F.col(ts).isNotNull() & F.col(referrer).contains(site))


def with_source(df: DataFrame, referrer: str, params: str, site: str, param: str = "source") -> DataFrame:
    """Visits with the category of the referring page and a 0/1 flag for a source parameter."""
    flagged = df.withColumn("has_source_param", has_query_param(F.col(params), param).cast("int"))
    return with_page_category(flagged, referrer, site)


def source_counts(df: DataFrame, ts: str, referrer: str, params: str, site: str) -> DataFrame:
    """Site-internal visits by page category and source parameter, most frequent first."""
    visits = with_source(site_visits(df, ts, referrer, site), referrer, params, site)
    return count_by(visits, "page_category", "has_source_param")


def back_navigation(
    df: DataFrame, cookie: str, ts: str, tiebreak: str, referrer: str, url: str, params: str, site: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Site-internal visits with a 0/1 flag: does the visit lead to where the session's previous one came from?

    The first visit of a session is no way back.
    """
    visits = with_source(site_visits(df, ts, referrer, site), referrer, params, site).withColumn(
        "session_key", session_key(F.col(cookie))
    )
    lagged = lag_by_key(visits, ["session_key"], [ts, tiebreak], referrer, "previous_referrer", hot_rows)
    back = F.when(F.col(url).contains(F.col("previous_referrer")), 1).otherwise(0)
    return lagged.withColumn("is_back", back).select(
        ts, tiebreak, "session_key", referrer, url, params, "previous_referrer", "is_back", "has_source_param"
    )


def enrich_agents(df: DataFrame, user_agent: str, app: AppNames) -> DataFrame:
    """Flat device, system and agent columns behind the others."""
    return with_agent_columns(df, user_agent, app)


def agent_inventory(df: DataFrame, user_agent: str, app: AppNames) -> DataFrame:
    """Every distinct agent string, without quotes, with its attributes."""
    agents = distinct_values(df, strip_quotes(F.col(user_agent)).alias(user_agent))
    return enrich_agents(agents, user_agent, app)


def registration_report(df: DataFrame, app: AppNames) -> DataFrame:
    """Registrations with agent columns, without embedded browsers and unknown agents, in order of time.

    The class alone is cheap and decides which rows stay; the rest is worked
    out behind the sort, whose sampling would otherwise do it twice.
    """
    kept = df.where(agent_class(F.col("user_agent"), app) != "Browser Webview")
    ordered = kept.orderBy("registration_date", "registration_hour", "email")
    return enrich_agents(ordered, "user_agent", app).select(
        "user_id", "email", "email_domain", "registration_date", "registration_hour", "confirmation_date",
        "is_confirmed", "is_gplus", "page_type", "device_class", "os_name", "os_version", "agent_name",
        "agent_version", "device_brand", "device_name", "client_id",
    )
