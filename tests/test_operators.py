from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import plan
from pyspark.sql import functions as F

from clicklake.operators import aggregates, geo, joins, outliers, profile, projection, templates, visits
from clicklake.operators.templates import fill_templates
from clicklake.plans import relational


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- joins ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def tools(spark):
    data = [("saw", 20), ("axe", 10), ("rake", 20), ("lamp", None), ("hoe", 10), ("file", 30), ("awl", 30), ("rope", 90)]
    return projection.values_table(spark, data, "tool string, shelf int")


@pytest.fixture(scope="module")
def shelves(spark):
    data = [(10, "left"), (20, "middle"), (30, "right"), (40, "empty"), (50, "spare")]
    return projection.values_table(spark, data, "number int, place string")


ON = [("shelf", "number")]


def test_row_counts_of_joins(tools, shelves):
    assert joins.inner_join(tools, shelves, ON).count() == 6
    assert joins.left_join(tools, shelves, ON).count() == 8
    assert joins.right_join(tools, shelves, ON).count() == 8
    assert joins.full_join(tools, shelves, ON).count() == 10
    assert joins.semi_join(tools, shelves, ON).count() == 6
    assert rows(joins.anti_join(tools, shelves, ON)) == [("lamp", None), ("rope", 90)]


@pytest.mark.parametrize("hot", [False, True])
def test_joins_equal_sparks_own_with_hot_and_null_keys(spark, hot):
    rng = random.Random(2)

    def side(prefix, n):
        data = [(rng.choice([None, 1, rng.randrange(2, 40)]), f"{prefix}{i}") for i in range(n)]
        return spark.createDataFrame(data, f"{prefix}k int, {prefix}v string")

    left, right, on = side("l", 300), side("r", 200), [("lk", "rk")]
    plain = {how: left.join(right, left.lk == right.rk, how) for how in ("left", "right", "full", "left_semi", "left_anti")}
    assert rows(joins.left_join(left, right, on, hot_right=hot)) == rows(plain["left"])
    assert rows(joins.right_join(left, right, on, hot_left=hot)) == rows(plain["right"])
    assert rows(joins.full_join(left, right, on, hot_right=hot)) == rows(plain["full"])
    assert rows(joins.semi_join(left, right, on)) == rows(plain["left_semi"])
    assert rows(joins.anti_join(left, right, on)) == rows(plain["left_anti"])


def test_broadcast_only_below_the_limits(tools, shelves, no_broadcast):
    assert "BroadcastHashJoin" in plan(joins.inner_join(tools, joins.broadcast_if_small(shelves, 5), ON))
    assert "SortMergeJoin" in plan(joins.inner_join(tools, joins.broadcast_if_small(shelves, 4), ON))
    assert joins.is_small(shelves, 5, max_bytes=1000) and not joins.is_small(shelves, 5, max_bytes=100)


def test_hot_key_is_split_in_a_left_join(spark, no_broadcast):
    """A key with a third of the rows is read by several tasks."""
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    left = spark.range(0, 60_000, 1, 8).select(hot.alias("k"), F.col("id").alias("v"))
    right = spark.range(-1, 60_000, 1, 8).select(F.col("id").alias("r"))
    joined = joins.left_join(left, right, [("k", "r")])
    assert joined.count() == 60_000
    joined.collect()
    text = plan(joined)
    for k, v in before.items():
        spark.conf.set(k, v)
    assert "skew=true" in text


# -- geo -----------------------------------------------------------------------

GEO = "start bigint, end bigint, geo struct<countryName:string,region:string,timezone:string>"


def geo_case(spark):
    rng = random.Random(4)
    ranges, position = [], 0
    while position < 2**32 - 2**27:
        start = position + rng.choice([0, 1, rng.randrange(2**20)])
        end = start + rng.choice([0, 255, 65535, 65536, rng.randrange(2**25)])
        ranges.append((start, end, (f"c{len(ranges)}", None, None)))
        position = end + 1
    edges = [n for s, e, _ in ranges for n in (s, e, e + 1)][:300]
    numbers = edges + [rng.randrange(2**32) for _ in range(300)]
    addresses = [".".join(str(n >> s & 255) for s in (24, 16, 8, 0)) for n in numbers] + [None, "", "bad"] + ["9.9.9.9"] * 300

    def place(ip):
        parts = (ip or "x").split(".")
        if len(parts) != 4:
            return None
        number = sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0)))
        return next((g[0] for s, e, g in ranges if s <= number <= e), None)

    df = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, ip string")
    return df, spark.createDataFrame(ranges, GEO), {i: place(a) for i, a in enumerate(addresses)}


@pytest.mark.parametrize("limit", [0, 10**7])
def test_range_lookup_against_brute_force(spark, limit):
    df, ranges, expected = geo_case(spark)
    got = geo.range_lookup(df, "ip", ranges, max_broadcast_rows=limit)
    assert got.columns == ["i", "ip", "geo"]
    assert {r.i: r.geo.countryName if r.geo else None for r in got.collect()} == expected
    assert geo.overlapping_ranges(ranges).count() == 0


def test_overlaps_are_found(spark):
    ranges = spark.createDataFrame([(0, 10, None), (10, 20, None), (70_000, 80_000, None)], GEO)
    assert geo.overlapping_ranges(ranges).count() == 1


@pytest.mark.parametrize("limit", [0, 1000])
def test_the_narrowest_of_overlapping_ranges_counts(spark, limit):
    spans = [(0, 100), (10, 20), (20, 30), (15, 15), (40, 60), (50, 70), (80, 90), (80, 90), (65_000, 140_000), (66_000, 70_000)]
    named = [(s, e, (f"r{i}", None, None)) for i, (s, e) in enumerate(spans)]
    numbers = [0, 9, 10, 15, 16, 20, 21, 30, 31, 45, 50, 60, 61, 70, 71, 85, 100, 101, 65_999, 66_000, 70_001, 140_000, 140_001]
    df = spark.createDataFrame([(n, f"0.{n >> 16}.{n >> 8 & 255}.{n & 255}") for n in numbers], "n int, ip string")
    got = geo.range_lookup(df, "ip", spark.createDataFrame(named, GEO), max_broadcast_rows=limit).collect()

    def narrowest(n):
        fits = [(e - s, s, f"r{i}") for i, (s, e) in enumerate(spans) if s <= n <= e]
        return min(fits)[2] if fits else None

    assert {r.n: r.geo and r.geo.countryName for r in got} == {n: narrowest(n) for n in numbers} and len(got) == len(numbers)


def test_large_range_tables_are_not_broadcast(spark, no_broadcast):
    df, ranges, _ = geo_case(spark)
    text = plan(geo.range_lookup(df, "ip", ranges, max_broadcast_rows=0))
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_unknown_places_count_once(spark):
    df = spark.createDataFrame(
        [("d", 1, '{"countryName":"A"}'), ("d", 1, '{"region":"A"}'), ("d", 1, ""), ("d", 1, ""), ("d", 2, "")],
        "date_ string, user_id int, geo_json string",
    )
    assert rows(geo.geo_mobility(df, "date_", "user_id", geo="geo_json")) == [("d", 1, 3), ("d", 2, 1)]


def test_client_time_falls_back(spark):
    ranges = spark.createDataFrame([(0, 0, ("A", None, "Asia/Tokyo")), (1, 1, ("B", None, None))], GEO)
    noon = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(noon, ip) for ip in ("0.0.0.0", "0.0.0.1", "9.9.9.9", None)], "ts timestamp_ntz, ip string")
    got = {r.ip: (r.timezone, r.client_time) for r in geo.client_time(df, "ts", "ip", ranges).collect()}
    default = ("America/New_York", noon)
    assert got == {"0.0.0.0": ("Asia/Tokyo", noon + timedelta(hours=9)), "0.0.0.1": default, "9.9.9.9": default, None: default}


def test_client_time_of_instants_in_any_session_zone(spark):
    ranges = spark.createDataFrame([(0, 0, ("A", None, "Asia/Tokyo"))], GEO)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    df = spark.sql("select timestamp_seconds(0) as ts, '0.0.0.0' as ip")
    local = geo.client_time(df, "ts", "ip", ranges).select(F.col("client_time").cast("string")).first()[0]
    spark.conf.set("spark.sql.session.timeZone", before)
    assert local == "1970-01-01 09:00:00"


# -- aggregates and profiles -----------------------------------------------------


def test_distinct_counts_take_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, None)], "a int, b string")
    assert rows(aggregates.distinct_per_column(df, ["a", "b"])) == [("a", 2), ("b", 2)]
    assert rows(aggregates.distinct_per_column(df.limit(0), ["a"])) == [("a", 0)]


def test_pivot_fills_zero(spark):
    df = spark.createDataFrame([(0,), (0,), (1,)], "m int")
    assert rows(aggregates.pivot_counts(df, "m", [0, 1, 2])) == [(0, 2, 0, 0), (1, 0, 1, 0)]


def test_profile_of_one_day(spark):
    data = [(date(2024, 1, 1), 1), (date(2024, 1, 1), 3), (date(2024, 1, 1), None), (date(2024, 1, 2), 100)]
    df = spark.createDataFrame(data, "date_ date, v int")
    day = date(2024, 1, 1)
    got = {r.name: r.value for r in profile.profile(df, "v", "t", day).collect()}
    assert got == {
        "ApproxQuantile-0.5": 1.0, "Mean": 2.0, "StandardDeviation": 1.0, "Maximum": 3.0, "Minimum": 1.0,
        "Histogram.bins": 3.0, "Histogram.abs.1": 1.0, "Histogram.abs.3": 1.0, "Histogram.abs.NullValue": 1.0,
        "Histogram.ratio.1": 1 / 3, "Histogram.ratio.3": 1 / 3, "Histogram.ratio.NullValue": 1 / 3,
    }
    assert {(r.date_, r.type_) for r in profile.profile(df, "v", "t", day).collect()} == {(day, "t")}


def test_day_type_profiles_equal_single_ones(spark):
    days = [date(2024, 1, 1) + timedelta(days=i % 14) for i in range(200)]
    data = [(d, None if i % 17 == 0 else i % 23) for i, d in enumerate(days)]
    df = spark.createDataFrame(data, "date_ date, v int")
    got = {(r.type_, r.name): r.value for r in profile.profile_by_day_type(df, "v", "date_", "m", 10).collect()}
    expected = {}
    for label, weekend in (("weekdays", False), ("weekends", True)):
        part = df.where(F.dayofweek("date_").isin(1, 7) == weekend)
        for variant, subset in (("total", part), ("10", part.where("v <= 10"))):
            name = f"m_{label}_{variant}"
            expected.update({(name, r.name): r.value for r in profile.profile(subset, "v", name).collect()})
    assert got == pytest.approx(expected)


def test_outliers_need_two_days(spark):
    data = [("a", "d1")] * 10 + [("a", "d2")] * 2 + [("b", "d1")] * 50
    df = spark.createDataFrame(data, "key string, day string")
    found = outliers.sigma_outliers(df, "day", "key", k=1.0)
    assert [(r.key, r.day, r.page_views, r.is_outlier) for r in found.collect()] == [("a", "d1", 10, True)]
    assert outliers.sigma_outliers(df, "day", "key", k=3.0).count() == 0


@pytest.mark.parametrize("hot_rows", [0, 1, 10**6])
def test_growth_curve(spark, hot_rows):
    data = [(1, -1, 4), (1, 0, 6), (1, 70, 3), (2, 0, 0), (2, 70, 5), (None, 70, 1)]
    df = spark.createDataFrame(data, "c int, datediff int, n int")
    # 0: (6-4)/4 and 0 for a first row; 70: (3-6)/6, 100.0 after a zero, and 0 for a first row.
    assert rows(outliers.growth_curve(df, "c", "datediff", "n", hot_rows=hot_rows)) == [(0, 0.25), (70, pytest.approx(99.5 / 3))]


def test_templates(spark):
    data = [
        (1, 9, 1, "{a}-{b}", "{a}", "x"), (1, 9, 2, "{a}-{b}", "{b}", "y"), (1, 9, 3, "{a}-{b}", "x", "z"),
        (2, 9, 1, "{a}-{b}", "{a}", "x"), (3, 9, 2, "{a}", "{a}", "x"), (4, 9, 1, None, "{a}", "x"),
        (5, 9, 1, "{a}", "{a}", "x"), (5, 8, 1, "{a}", "{a}", "x"), (6, 9, 1, "", "{a}", "x"),
        (7, 9, 1, "{a}{b}", "{a}", "x"), (7, 9, 2, "{a}{b}", "{b}", "1"), (7, 9, 2, "{a}{b}", "{b}", "2"),
    ]
    df = spark.createDataFrame(data, "post int, template_id int, rownum int, template string, key string, value string")
    args = (df, ["post", "template_id"], ["post"], "template", "rownum", "key", "value")
    two = [(1, "x-y"), (2, "x-{b}"), (5, "x"), (7, "x1"), (7, "x2")]
    assert rows(fill_templates(*args, steps=2)) == two
    assert rows(fill_templates(*args)) == [(1, "z-y"), *two[1:]]


def test_cast_schema_order_and_bad_values(spark):
    df = spark.createDataFrame([("x", "1", "2024-01-01", 5)], "a string, b string, c string, d int")
    got = projection.cast_schema(df, "c date, a int")
    assert got.columns == ["b", "d", "c", "a"]
    assert rows(got) == [("1", 5, date(2024, 1, 1), None)]


def test_project_map_from_url_and_json(spark):
    from clicklake.functions import text

    data = [("/shop/basket", '{"user_id":41}'), ("/help", '{"user_id":7}'), ("/", '{"user_id":300}')]
    df = spark.createDataFrame(data, "url string, data string")
    columns = {
        "user_id": text.json_field(F.col("data"), "$.user_id"),
        "new_user_id": text.json_number_plus(F.col("data"), "$.user_id", 10),
        "url_first_level": text.path_level(F.col("url"), 1),
    }
    got = projection.project_map(df, columns, drop=["url", "data"])
    assert rows(got) == [("300", 310, ""), ("41", 51, "shop"), ("7", 17, "help")]


def test_first_visit_is_no_way_back(spark):
    site = "s.example"
    data = [
        ("c.1", 1, "http://s.example/a", "http://s.example/b"), ("c.2", 2, "http://s.example/b", "http://s.example/a"),
        ("c.1", 3, "http://s.example/a", "http://s.example/c"), (None, 4, "http://s.example/a", "http://s.example/a"),
        ("c.1", 5, "http://else.example", "http://s.example/a"), ("c.1", 6, None, "http://s.example/a"),
    ]
    df = spark.createDataFrame(
        [(c, datetime(2024, 1, 1, 0, i), i, r, u, "source" if i == 2 else None) for c, i, r, u in data],
        "cookie string, ts timestamp_ntz, id int, referrer string, url string, params string",
    )
    got = visits.back_navigation(df, "cookie", "ts", "id", "referrer", "url", "params", site)
    assert [(r.id, r.session_key, r.is_back, r.has_source_param) for r in got.orderBy("id").collect()] == [
        (1, "c", 0, 0), (2, "c", 1, 1), (3, "c", 0, 0), (4, None, 0, 0),
    ]


def test_literal_tables_do_not_shuffle_what_they_join(spark, no_broadcast):
    """An event type with all rows would be sorted by one task."""
    text = plan(relational.join_values(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning(event_type" not in text
