"""Each job from files to files."""

from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime, timedelta

import pytest
from conftest import plan

from clicklake import jobs
from clicklake.functions.user_agent import AppNames
from clicklake.sources import schemas
from clicklake.sources.files import read_json_folders, read_partition_leafs, write_csv

APP = AppNames(product="NewsReader", wrapper="com.newsreader.webwrapper", in_app="nr-.*-wrapper")
CHROME = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/80.0.1 Safari/537.36"
WEBVIEW = "Mozilla/5.0 (Linux; Android 9; moto g71; wv) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/80.0.2 Mobile Safari/537.36"
NATIVE = "(x; y; NewsReader/5 ios/12.1 a b v/5.0 app/NewsReader"
SITE = "s.example"


@pytest.fixture
def at(tmp_path):
    return lambda name: str(tmp_path / name)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def csv_rows(spark, path, header=True):
    return rows(spark.read.option("header", header).csv(path))


@pytest.fixture
def posts(spark, at):
    """Gzipped JSON lines below a folder per hour."""
    lines = [
        ("13", 1, "c.1", f"https://{SITE}/a", f"https://{SITE}/b", "?source=x", "0.0.0.1"),
        ("13", 2, "c.1", f"https://{SITE}/b", f"https://{SITE}/a", None, "0.0.0.1"),
        ("14", 3, "c.2", "https://else.example", f"https://{SITE}/a", None, "9.9.9.9"),
        ("14", 4, "d.1", f"https://{SITE}/b/c", f"https://{SITE}/a", None, None),
    ]
    for hour, number, cookie, referrer, url, params, ip in lines:
        record = {"req_time": f"2021-03-04T{hour}:00:0{number}.000000Z", "session_cookie": cookie, "referrer": referrer,
                  "url": url, "url_params": params, "machine_ip": ip, "page_key": str(number),
                  "page_type": "wide" if number != 3 else None, "user_agent": NATIVE if number < 3 else f"'{CHROME}'"}
        text = json.dumps({k: v for k, v in record.items() if v is not None})
        spark.createDataFrame([(text,)], "value string").write.mode("append").option("compression", "gzip").text(
            at(f"posts/2021/03/04/{hour}")
        )
    return at("posts")


@pytest.fixture
def ranges(spark, at):
    schema = "start bigint, end bigint, geo struct<countryName:string,region:string,city:string,timezone:string>"
    spark.createDataFrame([(0, 9, ("Japan", "Kanto", "Tokyo", "Asia/Tokyo"))], schema).write.parquet(at("ranges"))
    return at("ranges")


def test_visit_jobs(spark, posts, ranges, at):
    jobs.source_counts(spark, posts, SITE, at("counts"))
    assert csv_rows(spark, at("counts")) == [("a", "1", "1"), ("b", "0", "2")]
    jobs.back_navigation(spark, posts, SITE, at("back"))
    flagged = spark.read.option("header", True).csv(at("back"))
    assert flagged.columns == ["req_time", "session_key", "referrer", "url", "url_params", "previous_referrer",
                               "is_back", "has_source_param"]
    assert rows(flagged.select("session_key", "is_back")) == [("c", "0"), ("c", "1"), ("d", "0")]
    jobs.client_time(spark, posts, ranges, SITE, at("local"))
    local = spark.read.parquet(at("local")).select("page_key", "timezone", "client_time")
    assert rows(local) == [
        ("1", "Asia/Tokyo", datetime(2021, 3, 4, 22, 0, 1)), ("2", "Asia/Tokyo", datetime(2021, 3, 4, 22, 0, 2)),
        ("4", "America/New_York", datetime(2021, 3, 4, 14, 0, 4)),
    ]


def test_hourly_table(spark, posts, at):
    hours = {("2021-03-04", h): f"{posts}/2021/03/04/{h}" for h in ("13", "14")}
    jobs.hourly_table(spark, hours, "hourly_posts", at("hourly"))
    assert spark.sql("SELECT count(1) FROM hourly_posts WHERE hour = '13'").first()[0] == 2
    leafs = read_partition_leafs(spark, at("hourly"), ["date_=2021-03-04/hour=13", "date_=2021-03-04/hour=14"])
    assert leafs.count() == 4 and {"date_", "hour"} < set(leafs.columns)


def test_hours_are_one_scan_and_replaced_singly(spark, at):
    hours = {}
    for number in range(200):
        key = (f"2021-03-{1 + number // 24:02d}", f"{number % 24:02d}")
        hours[key] = at(f"raw/{key[0]}/{key[1]} h+1")
        os.makedirs(hours[key])
        with open(f"{hours[key]}/part.json", "w") as file:
            file.write(json.dumps({"page_key": str(number)}) + "\n")
    folders = {source: {"date_": d, "hour": h} for (d, h), source in hours.items()}
    assert plan(read_json_folders(spark, folders, schemas.RAW_POSTS)).count("FileScan") == 1
    jobs.hourly_table(spark, hours, "all_hours", at("all"))
    read = lambda: {(r.date_, r.hour): r.page_key for r in spark.table("all_hours").collect()}
    assert read() == {key: str(i) for i, key in enumerate(hours)}
    files_of = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{at('all')}/*/*/*.parquet")}
    before = files_of()
    again = ("2021-03-02", "05")
    with open(f"{hours[again]}/part.json", "w") as file:
        file.write(json.dumps({"page_key": "new"}) + "\n")
    os.makedirs(at("raw/later"))
    with open(at("raw/later/part.json"), "w") as file:
        file.write(json.dumps({"page_key": "later"}) + "\n")
    jobs.hourly_table(spark, {again: hours[again], ("2021-04-01", "00"): at("raw/lat*")}, "all_hours", at("all"))
    after, hour = files_of(), "date_=2021-03-02/hour=05"
    assert {f: t for f, t in before.items() if hour not in f} == {f: t for f, t in after.items() if hour not in f and "2021-04" not in f}
    assert read() == {key: str(i) for i, key in enumerate(hours)} | {again: "new", ("2021-04-01", "00"): "later"}


def test_agent_jobs(spark, posts, at):
    jobs.agent_inventory(spark, f"{posts}/*/*/*/*/*.gz", "wide", APP, "nr", at("agents"), at("attributes"))
    assert csv_rows(spark, at("agents"), header=False) == [(NATIVE,), (CHROME,)]
    assert csv_rows(spark, at("attributes")) == [(NATIVE, "iOS", "12.1", "NewsReader", "5.0", "Phone", None)]
    agents = [(f'"{NATIVE}"',), (CHROME,), (None,)]
    spark.createDataFrame(agents, "user_agent string").write.option("header", True).csv(at("list"))
    jobs.app_agents(spark, at("list"), APP, at("own"))
    assert csv_rows(spark, at("own")) == [("iOS", "12.1", "NewsReader", "5.0")]


def test_session_windows_report_each_session_once(spark, at):
    def second(s):
        return datetime(2022, 5, 17, 11, s // 60, s % 60)

    def events(data):
        return spark.createDataFrame([(u, second(s), p) for u, s, p in data], "user_id int, timestamp_ timestamp, page_key string")

    gap = timedelta(seconds=40)
    # User 7 leaves page m once; user 5 sees page m twice up to 530 s and goes on in the second window.
    parts = [
        (events([(7, 100, "m"), (5, 500, "m"), (5, 530, "m")]), 600),
        (events([(5, 601, "n"), (9, 650, "m")]), 700),
        (events([(8, 1000, "m")]), 1200),
    ]
    carry, found = None, []
    for number, (part, end) in enumerate(parts):
        jobs.session_window(spark, part, carry, second(end), gap, at(f"s{number}"), at(f"c{number}"))
        carry = at(f"c{number}")
        found.append(rows(spark.read.parquet(at(f"s{number}"))))
    # Its session ends at 570 s by page m, is carried from there, and is extended by the visit 31 s later.
    assert found[0] == [(7, 0, second(100), second(100))]
    assert (5, 0) not in {r[:2] for r in found[0]} and spark.read.parquet(at("c0")).count() == 1
    everyone = sorted(r for window in found for r in window)
    assert [(r[0], r[2]) for r in everyone] == [
        (5, second(500)), (7, second(100)), (8, second(1000)), (9, second(650)),
    ]
    assert spark.read.parquet(at("c2")).isEmpty()


def test_place_jobs(spark, ranges, at):
    data = [("d1", 1, "0.0.0.1", "Phone", None, "/a"), ("d1", 1, "0.0.0.2", "Phone", "x", "/a"), ("d1", 2, "8.8.8.8", None, None, "/b"),
            ("d1", 1, "bad", "Desktop", None, "/a")]
    schema = "date_ string, user_id int, machine_ip string, device_class string, device_brand string, url string"
    spark.createDataFrame(data, schema).write.parquet(at("views"))
    jobs.user_places(spark, at("views"), ranges, at("geo"), at("geo_agg"))
    assert rows(spark.read.parquet(at("geo_agg"))) == [("d1", 1, 2), ("d1", 2, 1)]
    assert rows(spark.read.parquet(at("geo")).select("machine_ip", "country_geo", "territory_geo").distinct()) == [
        ("0.0.0.1", "Japan", "Kanto"), ("0.0.0.2", "Japan", "Kanto"), ("8.8.8.8", None, None), ("bad", None, None)]
    counts = jobs.user_breakdown(spark, at("views"), ranges, 1, at("breakdown"))
    assert rows(counts) == [("device_brand", 2), ("device_class", 2), ("machine_ip", 3), ("url", 1)]
    assert csv_rows(spark, at("breakdown")) == [("Japan", "Kanto", "Tokyo", None, None, "2"), (None,) * 5 + ("1",)]


def test_metric_jobs(spark, at):
    data = [(date(2024, 1, 5), 1), (date(2024, 1, 6), 2000)]
    spark.createDataFrame(data, "date_ date, unique_page_views int").write.parquet(at("pv"))
    jobs.column_metrics(spark, at("pv"), "unique_page_views", at("metrics"))
    jobs.day_type_metrics(spark, {"page_views": (at("pv"), "unique_page_views")}, 1000, at("metrics"))
    metrics = spark.read.parquet(at("metrics"))
    found = {(r.type_, r.name): r.value for r in metrics.collect()}
    assert found["total", "Maximum"] == 2000 and found["total", "Histogram.bins"] == 2
    assert found["page_views_weekdays_total", "Mean"] == 1 and found["page_views_weekdays_1000", "Mean"] == 1
    assert found["page_views_weekends_total", "Mean"] == 2000 and ("page_views_weekends_1000", "Mean") not in found
    assert metrics.columns == ["date_", "type_", "name", "value"]


def test_view_outliers(spark, at):
    data = [(datetime(2024, 1, d, 10, 5), 7, CHROME, None, "https://long.example/path", 1) for d in (1, 2) for _ in range(9 if d == 1 else 8)]
    data.append((datetime(2024, 1, 1), 7, CHROME, "d.example", "u", 99))
    schema = "ts timestamp, user_id int, user_agent string, referrer_domain string, url string, content_id int"
    wide = spark.createDataFrame(data, schema).unionByName(spark.createDataFrame([], schemas.FRAUD_PAGE_VIEWS), allowMissingColumns=True)
    columns = spark.createDataFrame([], schemas.FRAUD_PAGE_VIEWS).columns
    write_csv(wide.select(columns), at("views"))
    jobs.view_outliers(spark, at("views"), {1: "One"}, APP, at("facts"), at("outliers"))
    facts = spark.read.parquet(at("facts")).select("date_", "hour_", "minute_", "referrer_", "os_name", "title").distinct()
    assert rows(facts)[0] == ("2024-01-01", "2024-01-01 10", "05", "https://long.exa", "Windows NT", "One")
    assert rows(spark.read.parquet(at("outliers")).select("date_", "page_views")) == [("2024-01-01", 9), ("2024-01-02", 8)]


def test_growth_templates_pivot(spark, at):
    spark.createDataFrame([(1, 0, 4), (1, 1, 6), (2, 0, 1)], "content_id int, datediff int, count int").write.option("header", True).csv(at("c"))
    jobs.growth_by_age(spark, at("c"), at("growth"))
    assert csv_rows(spark, at("growth")) == [("0", "0.0"), ("1", "0.5")]
    pairs = [(1, 2, 1, "{a} {b}", "{a}", "x"), (1, 2, 2, "{a} {b}", "{b}", "y"), (3, 2, 1, "{a}", "{a}", None)]
    schema = "post_id int, template_id int, rownum int, template string, key string, value string"
    spark.createDataFrame(pairs, schema).write.parquet(at("kv"))
    jobs.disclosures(spark, at("kv"), "post_id", "template_id", at("d"), at("d_csv"))
    assert rows(spark.read.parquet(at("d"))) == [(1, "x y"), (3, "{a}")]
    assert csv_rows(spark, at("d_csv"), header=False) == [("1", "x y"), ("3", "{a}")]
    pivoted = jobs.pivot_by_remainder(spark.range(1, 8).toDF("c1"), "c1", 4)
    assert rows(pivoted) == [(0, 1, 0, 0, 0), (1, 0, 2, 0, 0), (2, 0, 0, 2, 0), (3, 0, 0, 0, 2)]


def test_registrations(spark, at):

    data = [(2, "b@x", date(2024, 1, 2), 5, CHROME), (1, "a@x", date(2024, 1, 2), 5, NATIVE), (3, "c@x", date(2024, 1, 1), 9, WEBVIEW),
            (4, "d@x", date(2024, 1, 1), 9, None), (5, "e@x", date(2024, 1, 1), 23, CHROME)]
    short = "user_id bigint, email string, registration_date date, registration_hour int, user_agent string"
    empty = spark.createDataFrame([], schemas.REGISTRATIONS)
    wide = spark.createDataFrame(data, short).unionByName(empty, allowMissingColumns=True).select(empty.columns)
    write_csv(wide, at("reg"))
    jobs.registrations(spark, at("reg"), APP, at("report"))
    report = spark.read.option("header", True).csv(at("report"))
    assert [(r.user_id, r.os_name, r.agent_name) for r in report.orderBy("registration_date", "registration_hour", "email").collect()] == [
        ("5", "Windows NT", "Chrome"), ("1", "iOS", "NewsReader"), ("2", "Windows NT", "Chrome")]
    assert report.columns[-1] == "client_id" and len(report.columns) == 17


def test_log_jobs(spark, at):
    def log(year, positions, lines):
        width = max(positions) + 1
        text = ["\t".join(dict(zip(positions, line)).get(i, "z") for i in range(width)) for line in lines]
        spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(at(f"log_{year}.d"))

    log(2013, (36, 38, 1), [("7", "e", "2013-01-01 00:00:05"), ("7", "e", "2013-01-01 00:00:09"), ("", "f", "2013-01-01 00:00:00")])
    log(2018, (27, 28, 2), [("8", "g", "2018-01-01 00:00:05")])
    logs = {year: at(f"log_{year}*") for year in (2013, 2018)}
    jobs.identities(spark, logs, at("latest"))
    assert csv_rows(spark, at("latest/2013"), header=False) == [("7", "e", "2013-01-01T00:00:09.000000")]
    jobs.identities(spark, logs, at("distinct"), latest=False)
    assert csv_rows(spark, at("distinct/*"), header=False) == [("7", "e"), ("8", "g")]

    timings = [(datetime(2024, 1, 1, 0, 0, s), u, f"p{s}") for s, u in ((9, 2), (3, 2), (5, 1), (1, None))]

    empty = spark.createDataFrame([], schemas.PAGE_TIMING)
    wide = spark.createDataFrame(timings, "ts timestamp, user_id int, page_key string").unionByName(empty, allowMissingColumns=True)
    write_csv(wide.select(empty.columns), at("timing"), compression="bzip2")
    jobs.sorted_logs(spark, {at("timing"): at("sorted")})
    ordered = spark.read.option("header", True).csv(at("sorted")).select("user_id", "page_key").collect()
    assert [tuple(r) for r in ordered] == [("1", "p5"), ("2", "p3"), ("2", "p9")]

    readers = [("u1", 2019), ("u2", 2018), ("u3", 2019)]
    spark.createDataFrame(readers, "user_id string, year int").selectExpr("*", "timestamp'2019-01-01' as created_at", "date'2019-01-01' as last_seen").write.option("header", True).csv(at("mail"))
    jobs.mail_readers(spark, at("mail"), at("users"))
    assert csv_rows(spark, at("users")) == [("u1",), ("u2",), ("u3",)]
