from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicklake.functions import numbers, text, times
from clicklake.functions.user_agent import ATTRIBUTES, AppNames, agent_class, app_fallback, with_agent_columns

SITE = "site.example"
CASES = {
    None: "home",
    "": "home",
    f"https://{SITE}": "home",
    f"https://{SITE}/": "home",
    f"https://{SITE}/news/12": "news",
    f"https://{SITE}/account/portfolio/x": "portfolio",
    f"https://{SITE}/account/": "account",
    f"https://{SITE}/account": "account",
    "https://other.example/search?q=1": "search",
    "other.example": "other.example",
    "?x=1": "",
    "?": "home",
    f"https://{SITE}/a=b/c": "a=...",
    f"https://{SITE}//": "home",
    "//": "home",
    f"https://{SITE}/=/x": "home",
    f"https://{SITE}/a//b": "b",
    f"https://{SITE}/account/p=1/x": "p=...",
    "/symbol/A": "symbol",
    f"https%3A%2F%2F{SITE}%2Fnews%3Fa": "news",
    f"https://{SITE}/%zz/x": "%zz",
    "a///": "home",
}


def categories(spark, referrers, site=SITE):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(referrers)], "i int, referrer string")
    return [r.page_category for r in text.with_page_category(df, "referrer", site).orderBy("i").collect()]


def test_page_category_cases(spark):
    # After the first address, more than one slash in a row may hide the site: "https://SITE/a//b" is host-less.
    assert dict(zip(CASES, categories(spark, CASES))) == {**CASES, f"https://{SITE}/a//b": "b"}


@pytest.mark.parametrize("site", [SITE, "a.a"])
def test_page_category_is_one_level_without_query(spark, site):
    rng = random.Random(3)
    pieces = ["/", "//", "=", site, ".a", "a", "account", "news", "https:", "%2F", "+", "b.c", "&"]
    referrers = list({"".join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(2000)})
    plain = categories(spark, referrers, site)
    assert all(c is not None and "/" not in c and "?" not in c for c in plain)
    assert categories(spark, [r + "?q=1/2//3" for r in referrers], site) == plain
    known = categories(spark, [f"https://{site}/{level}/x" for level in ("news", "b.c")], site)
    assert known == ["news", "b.c"]


@pytest.mark.parametrize(
    ("params", "has"),
    [
        (None, False), ("", False), (" \t", False), ("source", True), ("?source=1", True), (" ?a=1&source=", True),
        ("a=source", False), ("sources=1", False), ("resource=1", False), ("Source=1", False), ("=", False),
        ("a&source", True), ("? source=1", False), ("source==x", True), ("a=1&?source=2", True), ("source\n?", False),
    ],
)
def test_query_param(spark, params, has):
    df = spark.createDataFrame([(params,)], "p string")
    assert df.select(text.has_query_param(F.col("p"), "source")).first()[0] is has


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column).first()[0]


def test_text_functions(spark):
    s = "string"
    assert one(spark, text.strip_quotes(F.col("a")), a=(s, "\"it's\"")) == "its"
    assert one(spark, text.strip_quotes(F.col("a")), a=(s, None)) is None
    assert one(spark, text.session_key(F.col("a")), a=(s, "abc.1.2")) == "abc"
    assert one(spark, text.session_key(F.col("a")), a=(s, "abc")) == "abc"
    replaced = text.replace_literal(F.col("t"), F.col("k"), F.col("v"))
    assert one(spark, replaced, t=(s, "a.b.$"), k=(s, "."), v=(s, "$1")) == "a$1b$1$"
    assert one(spark, replaced, t=(s, "a"), k=(s, ""), v=(s, "x")) == "a"
    assert one(spark, replaced, t=(s, "a"), k=(s, "a"), v=(s, None)) == "a"
    assert one(spark, replaced, t=(s, None), k=(s, "a"), v=(s, "b")) is None
    assert one(spark, text.path_level(F.col("a"), 1), a=(s, "/news/1")) == "news"
    assert one(spark, text.path_level(F.col("a"), 5), a=(s, "/news/1")) is None
    assert one(spark, text.json_number_plus(F.col("a"), "$.u", 10), a=(s, '{"u":1}')) == 11
    assert one(spark, text.json_number_plus(F.col("a"), "$.u", 10), a=(s, '{"u":"x"}')) is None
    assert one(spark, text.json_field(F.col("a"), "$.u"), a=(s, "")) is None


def test_numbers(spark):
    def change(count, previous):
        columns = numbers.growth(F.col("c"), F.col("p"))
        return one(spark, columns, c=("int", count), p=("int", previous))

    assert change(3, 2) == 0.5 and change(0, 0) == 100.0 and change(None, 0) is None and change(1, None) is None
    mod = numbers.floor_mod(F.col("x"), F.col("y"))
    for x in (-7, 0, 7):
        for y in (-3, 3):
            assert one(spark, mod, x=("int", x), y=("int", y)) == x % y
    ip = numbers.ip_to_long(F.col("a"))
    values = {"0.0.0.0": 0, "255.255.255.255": 2**32 - 1, "10.0.1.2": 10 * 2**24 + 258, "1.2.3": None,
              "1.2.3.256": None, "a.b.c.d": None, "": None, None: None, "1.2.3.4\n": None}
    assert {k: one(spark, ip, a=("string", k)) for k in values} == values


def test_times(spark):
    s = "string"
    assert one(spark, times.parse_date(F.col("a")), a=(s, "2024-02-29")) == date(2024, 2, 29)
    assert one(spark, times.parse_date(F.col("a")), a=(s, "2024-02-30")) is None
    with pytest.raises(Exception, match="CANNOT_PARSE|invalid|CAST"):
        one(spark, times.parse_date(F.col("a"), strict=True), a=(s, "nonsense"))
    assert one(spark, times.parse_second(F.col("a")), a=(s, "2012-03-04 03:04:05")) == datetime(2012, 3, 4, 3, 4, 5)
    assert one(spark, times.parse_second(F.col("a")), a=(s, "x")) is None
    summer = datetime(2024, 7, 1, 12)
    local = times.local_time(F.col("t"), F.col("z"), F.lit("UTC"))
    assert one(spark, local, t=("timestamp_ntz", summer), z=(s, "Europe/Paris")) == datetime(2024, 7, 1, 14)
    assert one(spark, local, t=("timestamp_ntz", summer), z=(s, None)) == summer
    ts = datetime(2024, 1, 6, 23, 59)
    assert one(spark, times.is_weekday(F.col("t")), t=("timestamp_ntz", ts)) == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_slices_hold_less_than_their_width(spark, kind):
    instants = [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), datetime(2024, 1, 1, 0, 0, 29, 999999)]
    df = spark.createDataFrame([(t,) for t in instants], f"ts {kind}")
    got = [r[0] for r in df.select(times.time_slice(df, "ts", timedelta(seconds=30))).collect()]
    assert got == [-30_000_000, 0, 1_704_067_200_000_000]


APP = AppNames(product="NewsReader", wrapper="com.newsreader.webwrapper", in_app="nr-.*-wrapper")
WEBKIT = "AppleWebKit/537.36 (KHTML, like Gecko)"
AGENTS = {
    f"Mozilla/5.0 (Windows NT 10.0; Win64; x64) {WEBKIT} Chrome/79.0.3945.16 Safari/537.36 Edge/20.04":
        ("Desktop", "Browser", "Windows NT", "10.0", "Edge", "20.04", None, "Desktop"),
    f"Mozilla/5.0 (Windows NT 6.1; Win64; x64) {WEBKIT} Chrome/71.0.3578.98 Safari/537.36 OPR/58.0.3135.65":
        ("Desktop", "Browser", "Windows NT", "6.1", "Opera", "58.0.3135.65", None, "Desktop"),
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:95.0) Gecko/20100101 Firefox/95.0":
        ("Desktop", "Browser", "Ubuntu", None, "Firefox", "95.0", None, "Linux Desktop"),
    f"Mozilla/5.0 (X11; CrOS x86_64 14388.61.0) {WEBKIT} Chrome/97.0.4692.77 Safari/537.36":
        ("Desktop", "Browser", "Chrome OS", "14388.61.0", "Chrome", "97.0.4692.77", None, "Desktop"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10.15; rv:95.0) Gecko/20100101 Firefox/95.0":
        ("Desktop", "Browser", "Mac OS", "10.15", "Firefox", "95.0", "Apple", "Apple Macintosh"),
    f"Mozilla/5.0 (Linux; Android 11; SM-X200) {WEBKIT} Chrome/80.0.4147.89 Safari/537.36":
        ("Tablet", "Browser", "Android", "11", "Chrome", "80.0.4147.89", "Samsung", "Samsung SM-X200"),
    f"Mozilla/5.0 (Linux; Android 10; Pixel 6) {WEBKIT} Chrome/80.0.4147.89 Mobile Safari/537.36":
        ("Phone", "Browser", "Android", "10", "Chrome", "80.0.4147.89", "Google", "Google Pixel 6"),
    "Mozilla/5.0 (iPad; CPU OS 13_3 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/15.1.4 Mobile/15E148 Safari/604.1":
        ("Tablet", "Browser", "iOS", "13.3", "Safari", "15.1.4", "Apple", "Apple iPad"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 15_4_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 [FBAN/FBIOS]":
        ("Phone", "Browser Webview", "iOS", "15.4.1", None, None, "Apple", "Apple iPhone"),
    "Examplecrawler/0.9 (reads pages; ask at crawl.example)":
        ("Robot", "Robot", None, None, None, None, None, None),
    "x; y; a b ios/12.1 c d": (None, "Unknown", None, None, None, None, None, None),
    "x; NewsReader iOS/12.1": ("Phone", "Mobile App", "iOS", "12.1", None, None, None, None),
    "x; y NewsReader q": (None, "Mobile App", None, None, None, None, None, None),
    "com.newsreader.webwrapper/4 (a; b; BeOS 5; d)": (None, "Mobile App", "BeOS", "5", None, None, None, None),
    "": (None,) * 8,
    None: (None,) * 8,
}


def test_agents(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(AGENTS)], "i int, ua string")
    parsed = with_agent_columns(df, "ua", APP)
    assert parsed.columns == ["i", "ua", *ATTRIBUTES.values()]
    assert {r[1]: tuple(r)[2:] for r in parsed.orderBy("i").collect()} == AGENTS
    classes = df.select("ua", agent_class(F.col("ua"), APP)).collect()
    assert {a: c for a, c in classes} == {a: v[1] for a, v in AGENTS.items()}


def test_app_fallback_names_agent_only_with_seven_tokens(spark):
    rows = ["(a; b; NewsReader/5 ios/12.1 c d v/5.0.2 app/NewsReader", "(a; NewsReader/5 Android/9 c",
            "NewsReader; nothing", "nr-x-wrapper/3 (tablet; slate-4; iOS/16.7.2)", "nr-x-wrapper/3 (tablet)"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(rows)], "i int, ua string")
    got = df.select("i", app_fallback(F.col("ua"), APP).alias("f")).orderBy("i").select("f.*").collect()
    assert [tuple(r) for r in got] == [
        ("iOS", "12.1", "NewsReader", "5.0.2"), ("Android", "9", None, None), (None,) * 4,
        ("iOS", "16.7.2", None, None), (None,) * 4,
    ]
