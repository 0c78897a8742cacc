"""Whole jobs: a source, operators and a sink.

Each job takes the paths it reads and writes. Results that are small by nature
(reports) are written as one file; everything else as Spark partitions it.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.functions.text import strip_quotes
from clicklake.functions.times import day, day_hour, minute, parse_second
from clicklake.functions.user_agent import AppNames
from clicklake.operators import geo, outliers, profile, sessions, visits
from clicklake.operators.aggregates import distinct_per_column, distinct_values, latest_by_key, pivot_counts
from clicklake.operators.joins import broadcast_if_small, join_using
from clicklake.operators.projection import values_table
from clicklake.operators.templates import fill_templates
from clicklake.sources import files, schemas

# Columns that reports and profiles are made of.
PLACE_FIELDS = ["countryName", "region", "city", "postalCode", "continent"]
VISITOR_FIELDS = ["device_class", "device_brand", "machine_ip", "url"]
AGENT_FIELDS = ["os_name", "os_version", "agent_name", "agent_version"]


def _posts(spark: SparkSession, posts: str) -> DataFrame:
    return files.read_json_tree(spark, posts, schemas.PAGE_POSTS)


# -- sessions -------------------------------------------------------------------


def session_window(
    spark: SparkSession, events: DataFrame, carry_in: str | None, end: datetime, gap: timedelta, out: str,
    carry_out: str,
) -> None:
    """Closed sessions of one window of events (user_id, timestamp_, page_key).

    ``carry_in`` holds the sessions the window before left open, ``carry_out``
    takes those that an event after ``end`` could still extend. Only the others
    go to ``out``, so that each session is in the ``out`` of one window.
    """
    names = {"user": "user_id", "ts": "timestamp_", "page": "page_key", "gap": gap}
    if carry_in is None:
        found = sessions.sessionize(events, **names)
    else:
        found = sessions.sessionize_next(events, files.read_parquet(spark, carry_in), **names)
    found = files.settled(found)
    files.write_parquet(sessions.closed_sessions(found, gap, F.lit(end)), out)
    files.write_parquet(sessions.open_sessions(found, boundary=F.lit(end), **names), carry_out)


# -- visits ---------------------------------------------------------------------


def source_counts(spark: SparkSession, posts: str, site: str, out: str) -> None:
    """Visits from pages of the site by page category and source parameter."""
    counts = visits.source_counts(_posts(spark, posts), "req_time", "referrer", "url_params", site)
    files.write_csv(counts, out, single_file=True)


def back_navigation(spark: SparkSession, posts: str, site: str, out: str) -> None:
    """Visits from pages of the site, flagged when they lead back."""
    flagged = visits.back_navigation(
        _posts(spark, posts), "session_cookie", "req_time", "page_key", "referrer", "url", "url_params", site
    )
    files.write_csv(flagged.drop("page_key"), out)


def client_time(spark: SparkSession, posts: str, ranges: str, site: str, out: str) -> None:
    """Visits from pages of the site with the visitor's zone and wall clock."""
    found = visits.site_visits(_posts(spark, posts), "req_time", "referrer", site)
    files.write_parquet(geo.client_time(found, "req_time", "machine_ip", files.read_parquet(spark, ranges)), out)


def hourly_table(spark: SparkSession, hours: Mapping[tuple[str, str], str], name: str, path: str | None = None) -> None:
    """A table partitioned by ``date_`` and ``hour`` from raw posts, a folder per (date, hour).

    All hours are one scan. Hours that the table has already are replaced, others stay as they are.
    """
    folders = {source: {"date_": date_, "hour": hour} for (date_, hour), source in hours.items()}
    rows = files.read_json_folders(spark, folders, schemas.RAW_POSTS)
    files.replace_partitions(rows, name, ["date_", "hour"], path)


# -- places ---------------------------------------------------------------------


def user_places(spark: SparkSession, addresses: str, ranges: str, out: str, out_per_day: str) -> None:
    """Users' addresses (date_, user_id, machine_ip) with their places, and the number of places per user and day."""
    located = geo.range_lookup(files.read_parquet(spark, addresses), "machine_ip", files.read_parquet(spark, ranges))
    country, territory = F.col("geo.countryName"), F.col("geo.region")
    located = located.withColumns({"country_geo": country, "territory_geo": territory})
    files.write_parquet(geo.geo_json(located), out)
    per_day = geo.geo_mobility(files.read_parquet(spark, out), "date_", "user_id", geo="geo_json")
    files.write_parquet(per_day.withColumnRenamed("places", "geo_id"), out_per_day)


def user_breakdown(spark: SparkSession, views: str, ranges: str, user_id: int, out: str) -> DataFrame:
    """One user's page views by place, as a report; returns how many devices, addresses and pages there were."""
    own = files.read_parquet(spark, views).where(F.col("user_id") == user_id)
    located = geo.range_lookup(own, "machine_ip", files.read_parquet(spark, ranges))
    files.write_csv(geo.geo_breakdown(located, PLACE_FIELDS), out, single_file=True)
    return distinct_per_column(own, VISITOR_FIELDS)


# -- profiles, outliers, growth ---------------------------------------------------


def column_metrics(
    spark: SparkSession, source: str, column: str, target: str, type_: str = "total", day_: date | None = None,
    **sink,
) -> None:
    """Append the profile of a column to the metrics table."""
    files.append_metrics(profile.profile(files.read_parquet(spark, source), column, type_, day_), target, **sink)


def day_type_metrics(
    spark: SparkSession, measures: Mapping[str, tuple[str, str]], cap: int, target: str, **sink
) -> None:
    """Append the weekday and weekend profiles of several measures, ``{label: (path, column)}``."""
    for label, (source, column) in measures.items():
        metrics = profile.profile_by_day_type(files.read_parquet(spark, source), column, "date_", label, cap)
        files.append_metrics(metrics, target, **sink)


def view_outliers(
    spark: SparkSession, views: str, titles: Mapping[int, str], app: AppNames, out_views: str, out: str
) -> None:
    """Page views of some articles with time, agent and referrer columns, and the days with too many of them."""
    articles = values_table(spark, list(titles.items()), "content_id int, title string")
    ts = F.col("ts")
    read = files.read_csv(spark, views, schemas.FRAUD_PAGE_VIEWS).withColumns(
        {
            "date_": day(ts),
            "hour_": day_hour(ts),
            "minute_": minute(ts),
            "referrer_": F.coalesce("referrer_domain", F.substring("url", 1, 16)),
        }
    )
    enriched = visits.enrich_agents(join_using(read, broadcast_if_small(articles), ["content_id"]), "user_agent", app)
    columns = ["os_name", "agent_name", "agent_version", "user_id", "date_", "hour_", "minute_", "content_id",
               "title", "referrer_", "referrer", "referrer_domain", "country_geo"]
    files.write_parquet(enriched.select(columns), out_views)
    files.write_parquet(outliers.sigma_outliers(files.read_parquet(spark, out_views), "date_", "content_id"), out)


def growth_by_age(spark: SparkSession, counts: str, out: str) -> None:
    """Mean growth of contents by age, from a CSV file of (content_id, datediff, count)."""
    curve = outliers.growth_curve(files.read_csv_inferred(spark, counts), "content_id", "datediff", "count")
    files.write_csv(curve, out, single_file=True)


def pivot_by_remainder(df: DataFrame, key: str, divisor: int) -> DataFrame:
    """Rows by the remainder of a key, one column per remainder."""
    return pivot_counts(df.select(F.pmod(key, F.lit(divisor)).alias("mod")), "mod", range(divisor)).orderBy("mod")


# -- templates, agents, registrations, exports --------------------------------------


def disclosures(spark: SparkSession, key_values: str, post: str, template_id: str, out: str, out_csv: str) -> None:
    """Filled disclosure texts per post, as parquet and as CSV."""
    read = files.read_parquet(spark, key_values)
    filled = fill_templates(read, [post, template_id], [post], "template", "rownum", "key", "value")
    files.write_parquet(filled.withColumnRenamed("filled", "disclosure"), out)
    files.write_csv(files.read_parquet(spark, out), out_csv, header=False)


def registrations(spark: SparkSession, source: str, app: AppNames, out: str) -> None:
    """The registration report, sorted across its files."""
    files.write_csv(visits.registration_report(files.read_csv(spark, source, schemas.REGISTRATIONS), app), out)


def app_agents(spark: SparkSession, agents: str, app: AppNames, out: str) -> None:
    """Systems and versions of the site's own apps, from a CSV file of agent strings."""
    read = files.read_csv(spark, agents, schemas.USER_AGENTS)
    read = read.withColumn("user_agent", strip_quotes(F.col("user_agent")))
    own = visits.enrich_agents(read.where(F.col("user_agent").contains(app.product)), "user_agent", app)
    files.write_csv(own.select(AGENT_FIELDS), out)


def agent_inventory(
    spark: SparkSession, posts: str, page_type: str, app: AppNames, prefix: str, out_agents: str, out: str
) -> None:
    """Distinct agent strings of a page type, and the attributes of those of the site's own apps."""
    agent = F.col("user_agent")
    of_type = files.read_json_inferred(spark, posts).where(F.col("page_type").eqNullSafe(F.lit(page_type)))
    files.write_csv(distinct_values(of_type, strip_quotes(agent)), out_agents, header=False)
    read = files.read_positional(spark, out_agents, {"user_agent": 0})
    own = agent.isNotNull() & F.lower(agent).contains(app.product.lower()) | agent.startswith(prefix)
    enriched = visits.enrich_agents(read.where(own), "user_agent", app)
    files.write_csv(enriched.select("user_agent", *AGENT_FIELDS, "device_class", "device_brand"), out)


def sorted_logs(spark: SparkSession, sources: Mapping[str, str]) -> None:
    """Page timings sorted by user and time, ``{source: target}``, as bzip2 CSV."""
    for source, target in sources.items():
        timed = files.read_csv(spark, source, schemas.PAGE_TIMING).where("user_id is not null")
        files.write_csv(files.sorted_export(timed, ["user_id"], ["ts"]), target, compression="bzip2")


def mail_readers(spark: SparkSession, source: str, out: str) -> None:
    """Users of a mail list, those of a year together."""
    readers = files.spread_by(files.read_csv(spark, source, schemas.MAIL_READERS), "year")
    files.write_csv(readers.select("user_id"), out)


def identities(spark: SparkSession, logs: Mapping[int, str], out: str, latest: bool = True) -> None:
    """(user, email) pairs of each year's headerless log, distinct or with their latest time."""
    for year, path in logs.items():
        read = files.read_positional(spark, path, schemas.log_layout(year), sep="\t").where("user_id is not null")
        if latest:
            timed = read.withColumn("ts", parse_second(F.col("ts")))
            pairs = latest_by_key(timed, ["user_id", "email"], "ts")
        else:
            pairs = distinct_values(read, "user_id", "email")
        files.write_csv(pairs, f"{out}/{year}", header=False)
