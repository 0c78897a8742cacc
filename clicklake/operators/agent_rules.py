"""All attributes of user agents by a table of rules.

A rule is a row: which piece of an agent string it is about, what field it fills, and how it ranks. An agent string has
two kinds of pieces, products (``Name/1.2``) and items of its comments (``(X11; Linux x86_64)``), and an item is looked
up by each of its first words, so that longer keys can say more. The rules are indexed by piece: every distinct agent
string is taken apart once, its pieces join the rules they name, and of each field the rule of the highest rank counts,
then the one of the longest key. Rows take the attributes by joining their agent string. New families are new rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicklake.functions.user_agent import AppNames, with_agent_columns
from clicklake.operators.joins import broadcast_if_small
from clicklake.operators.projection import values_table
from clicklake.sources.files import settled

RULES_SCHEMA = "kind string, key string, field string, rank int, name string, class string, shift int"
PRODUCT, ITEM = "product", "item"

# Fixed values: (kind, piece, field, rank, name, class, what to add to the major version).
RULES: list[tuple] = [
    (PRODUCT, "Safari", "agent", 1, "Safari", "Browser", None),
    (PRODUCT, "Version", "agent", 2, "Safari", "Browser", 0),
    (PRODUCT, "Chrome", "agent", 10, "Chrome", "Browser", 0),
    (PRODUCT, "CriOS", "agent", 10, "Chrome", "Browser", 0),
    (PRODUCT, "Chromium", "agent", 11, "Chromium", "Browser", 0),
    (PRODUCT, "HeadlessChrome", "agent", 11, "HeadlessChrome", "Browser", 0),
    (PRODUCT, "Firefox", "agent", 10, "Firefox", "Browser", 0),
    (PRODUCT, "FxiOS", "agent", 10, "Firefox", "Browser", 0),
    (PRODUCT, "Focus", "agent", 20, "Firefox Focus", "Browser", 0),
    (PRODUCT, "SeaMonkey", "agent", 20, "SeaMonkey", "Browser", 0),
    (PRODUCT, "Edge", "agent", 20, "Edge", "Browser", 0),
    (PRODUCT, "Edg", "agent", 20, "Edge", "Browser", 0),
    (PRODUCT, "EdgA", "agent", 20, "Edge", "Browser", 0),
    (PRODUCT, "EdgiOS", "agent", 20, "Edge", "Browser", 0),
    (PRODUCT, "OPR", "agent", 20, "Opera", "Browser", 0),
    (PRODUCT, "OPT", "agent", 20, "Opera Touch", "Browser", 0),
    (PRODUCT, "Vivaldi", "agent", 20, "Vivaldi", "Browser", 0),
    (PRODUCT, "Brave", "agent", 20, "Brave", "Browser", 0),
    (PRODUCT, "SamsungBrowser", "agent", 20, "SamsungBrowser", "Browser", 0),
    (PRODUCT, "Silk", "agent", 20, "Silk", "Browser", 0),
    (PRODUCT, "GSA", "agent", 20, "GSA", "Browser", 0),
    (PRODUCT, "YaBrowser", "agent", 20, "YaBrowser", "Browser", 0),
    (PRODUCT, "UCBrowser", "agent", 20, "UCBrowser", "Browser", 0),
    (PRODUCT, "MiuiBrowser", "agent", 20, "MiuiBrowser", "Browser", 0),
    (PRODUCT, "DuckDuckGo", "agent", 20, "DuckDuckGo", "Browser", 0),
    (PRODUCT, "Whale", "agent", 20, "Whale", "Browser", 0),
    (PRODUCT, "QQBrowser", "agent", 20, "QQBrowser", "Browser", 0),
    (PRODUCT, "MQQBrowser", "agent", 20, "QQBrowser", "Browser", 0),
    (PRODUCT, "Maxthon", "agent", 20, "Maxthon", "Browser", 0),
    (PRODUCT, "Puffin", "agent", 20, "Puffin", "Browser", 0),
    (PRODUCT, "curl", "agent", 20, "Curl", "Robot", 0),
    (PRODUCT, "Wget", "agent", 20, "Wget", "Robot", 0),
    (ITEM, "MSIE", "agent", 25, "Internet Explorer", "Browser", 0),
    # The engine of a browser that no longer says its name counts four less than the browser.
    (PRODUCT, "Trident", "agent", 20, "Internet Explorer", "Browser", 4),
    (PRODUCT, "Gecko", "engine", 5, "Gecko", "Browser", None),
    (PRODUCT, "AppleWebKit", "engine", 10, "AppleWebKit", "Browser", 0),
    (PRODUCT, "Chrome", "engine", 20, "Blink", "Browser", 0),
    (PRODUCT, "Chromium", "engine", 20, "Blink", "Browser", 0),
    (PRODUCT, "Edge", "engine", 30, "EdgeHTML", "Browser", 0),
    (PRODUCT, "Trident", "engine", 30, "Trident", "Browser", 0),
    (PRODUCT, "Presto", "engine", 30, "Presto", "Browser", 0),
    (ITEM, "Windows NT", "system", 20, "Windows NT", "Desktop", 0),
    (ITEM, "Windows Phone", "system", 30, "Windows Phone", "Mobile", 0),
    (ITEM, "Android", "system", 20, "Android", "Mobile", 0),
    (ITEM, "CPU iPhone OS", "system", 20, "iOS", "Mobile", 0),
    (ITEM, "CPU OS", "system", 20, "iOS", "Mobile", 0),
    (ITEM, "Intel Mac OS X", "system", 20, "Mac OS", "Desktop", 0),
    (ITEM, "PPC Mac OS X", "system", 20, "Mac OS", "Desktop", 0),
    (ITEM, "CrOS", "system", 20, "Chrome OS", "Desktop", None),
    (ITEM, "CrOS x86_64", "system", 20, "Chrome OS", "Desktop", 0),
    (ITEM, "CrOS aarch64", "system", 20, "Chrome OS", "Desktop", 0),
    (ITEM, "Linux", "system", 5, "Linux", "Desktop", None),
    (ITEM, "Ubuntu", "system", 10, "Ubuntu", "Desktop", None),
    (ITEM, "Fedora", "system", 10, "Fedora", "Desktop", None),
    (ITEM, "FreeBSD", "system", 10, "FreeBSD", "Desktop", None),
    (ITEM, "Tizen", "system", 20, "Tizen", "Mobile", 0),
    (ITEM, "KAIOS", "system", 20, "KaiOS", "Mobile", 0),
    (PRODUCT, "KAIOS", "system", 20, "KaiOS", "Mobile", 0),
    (ITEM, "WOW64", "cpu", 20, "Intel x86_64", None, None),
    (ITEM, "Win64", "cpu", 20, "Intel x86_64", None, None),
    (ITEM, "x64", "cpu", 20, "Intel x86_64", None, None),
    (ITEM, "Linux x86_64", "cpu", 20, "Intel x86_64", None, None),
    (ITEM, "CrOS x86_64", "cpu", 20, "Intel x86_64", None, None),
    (ITEM, "Linux i686", "cpu", 20, "Intel i686", None, None),
    (ITEM, "Linux aarch64", "cpu", 20, "ARM aarch64", None, None),
    (ITEM, "Linux armv7l", "cpu", 20, "ARM v7", None, None),
    (ITEM, "CrOS aarch64", "cpu", 20, "ARM aarch64", None, None),
    (ITEM, "ARM64", "cpu", 20, "ARM aarch64", None, None),
    (ITEM, "Intel Mac OS X", "cpu", 10, "Intel", None, None),
    (ITEM, "PPC Mac OS X", "cpu", 10, "PowerPC", None, None),
    (ITEM, "U", "security", 10, "Strong security", None, None),
    (ITEM, "I", "security", 10, "Weak security", None, None),
    (ITEM, "N", "security", 10, "No security", None, None),
    *[(ITEM, code, "language", 10, name, code.lower(), None) for code, name in [
        ("de", "German"), ("de-DE", "German (Germany)"), ("en", "English"), ("en-GB", "English (United Kingdom)"),
        ("en-US", "English (United States)"), ("en-us", "English (United States)"), ("es", "Spanish"), ("es-ES", "Spanish (Spain)"),
        ("fr", "French"), ("fr-FR", "French (France)"), ("it", "Italian"), ("it-IT", "Italian (Italy)"), ("ja", "Japanese"),
        ("pt-BR", "Portuguese (Brazil)"), ("ru", "Russian"), ("ru-RU", "Russian (Russia)"), ("zh-CN", "Chinese (China)"),
    ]],
]

# Names of all attributes, in alphabetical order.
ATTRIBUTES = (
    "AgentClass", "AgentLanguage", "AgentLanguageCode", "AgentName", "AgentNameVersion", "AgentNameVersionMajor", "AgentSecurity",
    "AgentVersion", "AgentVersionMajor", "DeviceBrand", "DeviceClass", "DeviceCpu", "DeviceName", "DeviceVersion",
    "LayoutEngineClass", "LayoutEngineName", "LayoutEngineNameVersion", "LayoutEngineNameVersionMajor", "LayoutEngineVersion",
    "LayoutEngineVersionMajor", "OperatingSystemClass", "OperatingSystemName", "OperatingSystemNameVersion",
    "OperatingSystemNameVersionMajor", "OperatingSystemVersion", "OperatingSystemVersionMajor",
)
FIELDS = ("agent", "engine", "system", "cpu", "security", "language")
#: So many first words of an item are looked up.
WORDS = 4
_PRODUCT = r"([A-Za-z][A-Za-z0-9_.-]*)/v?(\d[\w.]*)"


def rule_table(spark: SparkSession, more: Sequence[tuple] = ()) -> DataFrame:
    """The rules as a table, with further rows of the same kind."""
    return values_table(spark, [*RULES, *more], RULES_SCHEMA)


def pieces(agents: DataFrame, user_agent: str) -> DataFrame:
    """(_agent_key, kind, key, version) of every piece of the agent strings; a version is null where there is none."""
    ua = F.col(user_agent)
    products = F.arrays_zip(
        F.regexp_extract_all(ua, F.lit(_PRODUCT), F.lit(1)).alias("key"), F.regexp_extract_all(ua, F.lit(_PRODUCT), F.lit(2)).alias("version")
    )
    named = agents.select(ua.alias("_agent_key"), F.explode(products).alias("p")).select(
        "_agent_key", F.lit(PRODUCT).alias("kind"), F.col("p.key").alias("key"), F.col("p.version").alias("version")
    )
    comments = F.regexp_extract_all(ua, F.lit(r"\(([^()]*)\)"), F.lit(1))
    items = agents.select(ua.alias("_agent_key"), F.explode(F.split(F.array_join(comments, ";"), ";")).alias("item"))
    items = items.withColumn("item", F.trim("item")).where("item <> ''")
    words = F.split("item", " ")
    starts = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(WORDS))), lambda k: F.array_join(F.slice(words, 1, k), " "))
    keyed = items.withColumn("key", F.explode(starts))
    rest = F.expr("substring(item, length(key) + 1)")
    version = F.nullif(F.regexp_extract(rest, r"\A[ /:]?v?(\d[\d._]*)", 1), F.lit(""))
    return named.union(keyed.select("_agent_key", F.lit(ITEM).alias("kind"), "key", version.alias("version")))


def matched(agents: DataFrame, user_agent: str, rules: DataFrame) -> DataFrame:
    """Per agent string a struct (name, class, version) of each field, null where no rule is met."""
    met = pieces(agents, user_agent).join(broadcast_if_small(rules), ["kind", "key"])
    plain = F.translate("version", "_", ".")
    moved = F.concat((F.substring_index(plain, ".", 1).try_cast("int") + F.col("shift")).cast("string"), F.regexp_extract(plain, r"\A\d+(.*)", 1))
    # A rule without a shift knows no version.
    version = F.when(F.col("shift") == 0, plain).when(F.col("shift").isNotNull(), moved)
    hit = F.struct("rank", F.length("key").alias("length"), "name", "class", version.alias("version"))
    best = [F.max(F.when(F.col("field") == field, hit)).alias(field) for field in FIELDS]
    return met.groupBy("_agent_key").agg(*best)


def _major(version: Column) -> Column:
    return F.substring_index(version, ".", 1)


def agent_attributes(agents: DataFrame, user_agent: str, app: AppNames, rules: DataFrame) -> DataFrame:
    """(user_agent, all attributes) of distinct agent strings; unknown ones are null, and so are those of an empty string."""
    # The flat columns say what rules do not: devices, the site's own apps, robots and embedded browsers.
    flat = with_agent_columns(agents.select(user_agent), user_agent, app)
    found = flat.join(matched(agents, user_agent, rules).withColumnRenamed("_agent_key", user_agent), user_agent, "left")
    own_app = F.col("agent_class") == "Mobile App"
    agent_name = F.when(own_app, F.col("agent_name")).otherwise(F.coalesce("agent.name", "agent_name"))
    agent_version = F.when(own_app, F.col("agent_version")).otherwise(F.coalesce("agent.version", "agent_version"))
    os_name, os_version = F.coalesce("system.name", "os_name"), F.coalesce("system.version", "os_version")
    engine, engine_version = F.col("engine.name"), F.col("engine.version")
    known = F.col("agent_class").isin("Robot", "Mobile App", "Browser Webview")
    build = F.nullif(F.regexp_extract(user_agent, r" Build/([^;) ]+)", 1), F.lit(""))
    both = lambda name, version: F.when(name.isNotNull() & version.isNotNull(), F.concat_ws(" ", name, version))
    values = {
        "AgentClass": F.when(known, F.col("agent_class")).otherwise(F.coalesce("agent.class", "agent_class")),
        "AgentLanguage": F.col("language.name"), "AgentLanguageCode": F.col("language.class"),
        "AgentName": agent_name, "AgentNameVersion": both(agent_name, agent_version),
        "AgentNameVersionMajor": both(agent_name, _major(agent_version)), "AgentSecurity": F.col("security.name"),
        "AgentVersion": agent_version, "AgentVersionMajor": _major(agent_version),
        "DeviceBrand": F.col("device_brand"), "DeviceClass": F.col("device_class"), "DeviceCpu": F.col("cpu.name"),
        "DeviceName": F.col("device_name"), "DeviceVersion": build,
        "LayoutEngineClass": F.col("engine.class"), "LayoutEngineName": engine, "LayoutEngineNameVersion": both(engine, engine_version),
        "LayoutEngineNameVersionMajor": both(engine, _major(engine_version)), "LayoutEngineVersion": engine_version,
        "LayoutEngineVersionMajor": _major(engine_version),
        "OperatingSystemClass": F.coalesce("system.class", F.when(os_name.isin("iOS", "Android"), F.lit("Mobile"))),
        "OperatingSystemName": os_name, "OperatingSystemNameVersion": both(os_name, os_version),
        "OperatingSystemNameVersionMajor": both(os_name, _major(os_version)), "OperatingSystemVersion": os_version,
        "OperatingSystemVersionMajor": _major(os_version),
    }
    return found.select(user_agent, *[values[a].alias(a) for a in ATTRIBUTES])


def with_agent_attributes(df: DataFrame, user_agent: str, app: AppNames, rules: DataFrame) -> DataFrame:
    """All rows with a struct ``agent`` of all attributes. Each distinct agent string is looked at once."""
    distinct = settled(df.select(user_agent).where(F.length(user_agent) > 0).distinct())
    parsed = agent_attributes(distinct, user_agent, app, rules)
    packed = parsed.select(F.col(user_agent).alias("_agent_key"), F.struct(*ATTRIBUTES).alias("agent"))
    return df.join(packed, F.col(user_agent) == F.col("_agent_key"), "left").drop("_agent_key")
