"""Attributes of agent strings by the table of rules."""

from __future__ import annotations

from clicklake.functions.user_agent import AppNames
from clicklake.operators.agent_rules import ATTRIBUTES, RULES, rule_table, with_agent_attributes
from clicklake.operators.joins import broadcast_if_small

APP = AppNames(product="NewsReader", wrapper="com.newsreader.webwrapper", in_app="nr-.*-wrapper")
ROBOT = "Mozilla/5.0 (compatible; examplebot/1.0)"
OLD = "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.0; WOW64; Trident/5.0; en-GB)"
WEBVIEW = "Mozilla/5.0 (Linux; Android 11; moto q8 Build/RPX; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/99.1 Mobile Safari/537.36"
WALRUS = "Mozilla/5.0 (X11; Linux i686) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0 Walrus/3.2 Safari/537.36"


def attributes(spark, agents, more=()):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(agents)], "i int, ua string")
    found = with_agent_attributes(df, "ua", APP, rule_table(spark, more))
    assert found.columns == ["i", "ua", "agent"] and found.schema["agent"].dataType.names == list(ATTRIBUTES)
    return {r.ua: r.agent and {k: v for k, v in r.agent.asDict().items() if v is not None} for r in found.collect()}


def test_all_attributes(spark):
    got = attributes(spark, [None, "", "?", ROBOT, OLD, WEBVIEW, OLD])
    assert len(ATTRIBUTES) == 26 and got[None] is None and got[""] is None and got["?"] == {"AgentClass": "Unknown"}
    assert got[ROBOT] == {"AgentClass": "Robot", "DeviceClass": "Robot"}
    assert got[OLD] == {
        "AgentClass": "Browser", "AgentLanguage": "English (United Kingdom)", "AgentLanguageCode": "en-gb", "AgentName": "Internet Explorer",
        "AgentNameVersion": "Internet Explorer 9.0", "AgentNameVersionMajor": "Internet Explorer 9", "AgentVersion": "9.0",
        "AgentVersionMajor": "9", "DeviceClass": "Desktop", "DeviceCpu": "Intel x86_64", "DeviceName": "Desktop",
        "LayoutEngineClass": "Browser", "LayoutEngineName": "Trident", "LayoutEngineNameVersion": "Trident 5.0",
        "LayoutEngineNameVersionMajor": "Trident 5", "LayoutEngineVersion": "5.0", "LayoutEngineVersionMajor": "5",
        "OperatingSystemClass": "Desktop", "OperatingSystemName": "Windows NT", "OperatingSystemNameVersion": "Windows NT 6.0",
        "OperatingSystemNameVersionMajor": "Windows NT 6", "OperatingSystemVersion": "6.0", "OperatingSystemVersionMajor": "6",
    }
    assert got[WEBVIEW]["AgentClass"] == "Browser Webview" and got[WEBVIEW]["AgentName"] == "Chrome"
    assert (got[WEBVIEW]["DeviceVersion"], got[WEBVIEW]["DeviceBrand"]) == ("RPX", "Motorola")


def test_rules_extend_without_code(spark):
    assert attributes(spark, [WALRUS])[WALRUS]["AgentName"] == "Chrome"
    more = [("product", "Walrus", "agent", 20, "Walrus", "Browser", 0), ("item", "Linux i686", "system", 20, "Old Linux", "Desktop", None)]
    got = attributes(spark, [WALRUS], more)[WALRUS]
    assert (got["AgentName"], got["AgentVersion"], got["LayoutEngineName"]) == ("Walrus", "3.2", "Blink")
    assert (got["OperatingSystemName"], got["DeviceCpu"]) == ("Old Linux", "Intel i686")


def test_rules_are_sound(spark):
    keys = [r[:3] for r in RULES]
    assert len(set(keys)) == len(keys) and len(RULES) < 200
    assert broadcast_if_small(rule_table(spark)).count() == len(RULES)
