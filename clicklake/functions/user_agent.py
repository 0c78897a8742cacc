"""User-agent attributes by rule.

A few regular expressions per row cover the main browser families. They run
inside the scan's own stage: nothing is shuffled, so an agent string that a
third of all rows share costs no more than any other. The rules are not a full
user-agent grammar; what they do not know stays null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

# Names of the parsed attributes and the flat columns made from them.
ATTRIBUTES = {
    "DeviceClass": "device_class",
    "AgentClass": "agent_class",
    "OperatingSystemName": "os_name",
    "OperatingSystemVersion": "os_version",
    "AgentName": "agent_name",
    "AgentVersion": "agent_version",
    "DeviceBrand": "device_brand",
    "DeviceName": "device_name",
}

# Name of an operating system, agent or maker by the token that announces it.
SYSTEMS = {
    "Windows NT": "Windows NT",
    "iPhone OS": "iOS",
    "CPU OS": "iOS",
    "Android": "Android",
    "CrOS": "Chrome OS",
    "Mac OS X": "Mac OS",
    "Ubuntu": "Ubuntu",
}
AGENTS = {
    "Edge": "Edge",
    "Edg": "Edge",
    "EdgA": "Edge",
    "EdgiOS": "Edge",
    "OPR": "Opera",
    "SamsungBrowser": "SamsungBrowser",
    "Silk": "Silk",
    "GSA": "GSA",
    "Firefox": "Firefox",
    "FxiOS": "Firefox",
    "Chrome": "Chrome",
    "CriOS": "Chrome",
    "Version": "Safari",
}
ENGINES = ["Chrome", "CriOS"]  # also part of the strings of other agents
OTHERS = [a for a in AGENTS if a not in [*ENGINES, "Version"]]
SYSTEM = rf"(?:{'|'.join(SYSTEMS)})(?:(?<=CrOS) \S+)?[ /-]?[\d._]*"
OTHER_AGENT = rf"\b({'|'.join(OTHERS)})/[\d.]+"
ENGINE = rf"\b({'|'.join(ENGINES)})/[\d.]+"
SAFARI = r"\bVersion/[\d.]+"
APPLE = r"\((iPhone|iPad|iPod|Macintosh)"
MODEL = r"Android [\d.]+; (?:[a-z]{2}(?:[-_][A-Za-z]{2})?; )?([^;)]+?)(?: Build/[^;)]*)?[;)]"
MAKERS = {
    "SAMSUNG": "Samsung",
    "SM-": "Samsung",
    "Pixel": "Google",
    "Nexus": "Google",
    "moto": "Motorola",
    "HTC": "HTC",
}
MAKER = rf"\A({'|'.join(MAKERS)})"
ROBOTS, ROBOT = ["bot", "crawler", "spider"], r"bot\b|crawler|spider"


@dataclass(frozen=True)
class AppNames:
    """How the site's own apps call themselves in agent strings."""

    product: str  # product token of the old native apps, case-sensitive
    wrapper: str  # package prefix of the web wrapper
    in_app: str  # pattern that starts an in-app agent string


def _bind(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """Name intermediate values: each is evaluated once, however often ``body`` uses it.

    Written out, the repeated parts would outgrow what the JVM compiles.
    """
    named = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.get(F.transform(F.array(named), body), 0)


def _name_of(token: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(text) for pair in names.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), token)


def _version_of(text: Column) -> Column:
    # Only the last blank-separated token is a version, and only if it starts with a digit.
    last = F.translate(F.substring_index(F.rtrim(text), " ", -1), "_", ".")
    return _bind({"last": last}, lambda v: F.when(v["last"].rlike(r"\A\d"), v["last"]))


def _is_wrapper(ua: Column, app: AppNames) -> Column:
    return ua.startswith(app.wrapper) | ua.rlike(rf"\A(?:{app.in_app})")


def app_fallback(ua: Column, app: AppNames) -> Column:
    """Struct of OS and agent of the site's own apps; null fields for other agents or odd shapes."""

    def fields(os_name: Column, os_version: Column, agent_name: Column, agent_version: Column) -> Column:
        return F.struct(
            os_name.alias("os_name"), os_version.alias("os_version"),
            agent_name.alias("agent_name"), agent_version.alias("agent_version"),
        )

    nothing = F.lit(None).cast("string")

    def native(v: Column) -> Column:
        # Old native apps: "...; <x> <y> <os>/<version> ... <version> <name>" after the last semicolon.
        tokens, os_name, os_version = v["tokens"], F.get(v["system"], 0), F.get(v["system"], 1)
        spelled = F.when(F.lower(os_name) == "ios", F.lit("iOS")).when(
            F.lower(os_name) == "android", F.lit("Android")
        ).otherwise(os_name)
        whole, seven = os_version != "", F.size(tokens) == 7
        return fields(
            F.when(whole, spelled),
            F.when(whole, os_version),
            F.when(whole & seven, F.substring_index(F.get(tokens, 6), "/", -1)),
            F.when(whole & seven, F.substring_index(F.get(tokens, 5), "/", -1)),
        )

    def wrapped(v: Column) -> Column:
        # Wrappers: "<prefix> (<x>; <y>; <os> <version>...", or "<os>/<version>)" in that place.
        whole = F.get(v["items"], 1).isNotNull()
        return fields(F.when(whole, F.get(v["items"], 0)), F.get(v["items"], 1), nothing, nothing)

    last = F.try_element_at(F.array_remove(F.split(ua, ";"), ""), F.lit(-1))
    tokens = F.split(F.rtrim(last), " ")
    third = F.rtrim(F.trim(F.get(F.split(ua, ";"), 2)), F.lit(")"))
    return (
        F.when(
            ua.contains(app.product),
            _bind({"tokens": tokens, "system": F.split(F.get(tokens, 2), "/")}, native),
        )
        .when(_is_wrapper(ua, app), _bind({"items": F.split(third, "[ /]")}, wrapped))
        .otherwise(fields(nothing, nothing, nothing, nothing))
    )


def _announces(ua: Column, tokens: list[str]) -> Column:
    # Plain searches are an order of magnitude cheaper than a pattern that finds nothing.
    return reduce(or_, [ua.contains(f"{token}/") for token in tokens])


def agent_class(ua: Column, app: AppNames) -> Column:
    """Kind of agent: robot, own app, embedded or plain browser, else Unknown; null for no agent."""
    lower = F.lower(ua)
    robot = reduce(or_, [lower.contains(text) for text in ROBOTS]) & lower.rlike(ROBOT)
    embedded = ua.contains("; wv)") | ua.contains("FBAN/") | (ua.contains(" Mobile/") & ~ua.contains(" Safari/"))
    return (
        F.when(robot, F.lit("Robot"))
        .when(ua.contains(app.product) | _is_wrapper(ua, app), F.lit("Mobile App"))
        .when(embedded, F.lit("Browser Webview"))
        .when(ua.contains(" Safari/") | _announces(ua, [*ENGINES, *OTHERS]), F.lit("Browser"))
        .when(F.length(F.trim(ua)) > 0, F.lit("Unknown"))
    )


def with_agent_columns(df: DataFrame, user_agent: str, app: AppNames) -> DataFrame:
    """Add the flat columns of ``ATTRIBUTES``; null for an empty or null agent string.

    The steps are columns of their own, so that each pattern runs once per row
    and the generated code stays small enough for the JVM to compile.
    """
    ua, os_name, model, apple = F.col("_ua"), F.col("os_name"), F.col("_model"), F.col("_apple")
    token, system = F.col("_token"), F.col("_system")
    tokens = (
        df.withColumn("_ua", F.nullif(F.col(user_agent), F.lit("")))
        .withColumns(
            {
                "agent_class": agent_class(ua, app),
                "_other": F.when(_announces(ua, OTHERS), F.regexp_extract("_ua", OTHER_AGENT, 0)),
                "_system": F.regexp_extract("_ua", SYSTEM, 0),
                "_apple": F.regexp_extract("_ua", APPLE, 1),
            }
        )
        .withColumn(
            "_token",
            F.when(F.col("_other") != "", F.col("_other"))
            .when(_announces(ua, ENGINES), F.regexp_extract("_ua", ENGINE, 0))
            .when(ua.contains(" Safari/"), F.regexp_extract("_ua", SAFARI, 0)),
        )
        .withColumns(
            {
                "_os_rule": F.coalesce(
                    _name_of(F.regexp_extract(system, rf"\A({'|'.join(SYSTEMS)})", 1), SYSTEMS),
                    F.when(ua.contains("Linux"), F.lit("Linux")),
                ),
                "_model": F.when(system.startswith("Android"), F.regexp_extract("_ua", MODEL, 1)),
            }
        )
        # App values only stand in where the rules see no operating system.
        .withColumn("_app", F.when(F.col("_os_rule").isNull(), app_fallback(ua, app)))
    )
    named = tokens.withColumns(
        {
            "os_name": F.coalesce("_os_rule", "_app.os_name"),
            "os_version": F.coalesce("_app.os_version", _version_of(system)),
            "agent_name": F.coalesce("_app.agent_name", _name_of(F.substring_index(token, "/", 1), AGENTS)),
            "agent_version": F.coalesce("_app.agent_version", _version_of(F.substring_index(token, "/", -1))),
            "device_brand": F.when(apple != "", F.lit("Apple")).otherwise(
                _name_of(F.regexp_extract(model, MAKER, 1), MAKERS)
            ),
        }
    )
    desktop = os_name.isin("Windows NT", "Mac OS", "Chrome OS", "Linux", "Ubuntu")
    tablet = (apple == "iPad") | ((os_name == "Android") & ~ua.contains("Mobile"))
    # The maker stands in front of the model once.
    device = F.concat_ws(" ", F.col("device_brand"), F.regexp_replace(model, r"\A(SAMSUNG|HTC) ", ""))
    described = named.withColumns(
        {
            "device_class": F.when(F.col("agent_class") == "Robot", F.lit("Robot"))
            .when(tablet, F.lit("Tablet"))
            .when(os_name.isin("iOS", "Android"), F.lit("Phone"))
            .when(desktop, F.lit("Desktop")),
            "device_name": F.when(apple != "", F.concat(F.lit("Apple "), apple))
            .when(model != "", device)
            .when(os_name.isin("Linux", "Ubuntu"), F.lit("Linux Desktop"))
            .when(desktop, F.lit("Desktop")),
        }
    )
    given = [c for c in df.columns if c not in ATTRIBUTES.values()]
    return described.select(*given, *ATTRIBUTES.values())


def with_agent_json(df: DataFrame, user_agent: str, app: AppNames, out: str) -> DataFrame:
    """Add the attributes as JSON text, without the unknown ones; null for an empty agent string."""
    attributes = F.to_json(F.struct(*[F.col(flat).alias(name) for name, flat in ATTRIBUTES.items()]))
    parsed = with_agent_columns(df, user_agent, app)
    return parsed.withColumn(out, F.when(F.length(user_agent) > 0, attributes)).drop(*ATTRIBUTES.values())
