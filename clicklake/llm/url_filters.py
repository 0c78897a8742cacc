"""URL filters by rules and by a tree of path templates.

Per host, segments of paths become templates: digits and long hex runs are variable at once; below a node of the tree,
a child stays a branch only if its labelled pages differ from its siblings' beyond chance, and all others merge into
one wildcard. A template is rejected when its smoothed share of bad pages reaches a threshold. The tree works on counts
per host and path shape, never on pages.

A url that is null or has no ``://`` has an empty host and path. Levels are decided as long as some node has enough
labelled pages below it for a branch; what is deeper, however long a path may be, is all wildcards. Pages whose
templates have no labels are allowed. Repeated page ids are judged row by row.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import filled
from clicklake.operators.skew import together
from clicklake.sources.files import settled

#: Levels that the SQL of the query spells out; the first one is what stands before the path's first slash.
DEPTH = 4
MIN_LABELLED = 20
Z2 = 9.0
STRENGTH = 10.0
BAD_SHARE = 0.5

#: (action, host, path prefix)
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(filled(url), pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(filled(url), pattern, 2)


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of its text and action; null if none does."""
    best = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        here = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))
        best = F.when(fits, here).otherwise(best)
    return best


def shape(path: Column) -> Column:
    """The path with long hex runs and digits replaced, which is what templates are made of."""
    return F.regexp_replace(F.regexp_replace(path, r"\b[0-9a-f]{16,}\b", "{x}"), "[0-9]+", "{n}")


def templates(shapes: DataFrame) -> DataFrame:
    """The template of every (host, shape), from rows (host, shape, labelled, bad).

    Levels are decided from the root downwards, each from the counts below the nodes of the level above, until no node has
    the labels that a branch and a sibling of it need. Segments below that are wildcards, all at once.
    """
    parts = F.split("shape", "/")
    rows = shapes.select("host", "shape", "labelled", "bad", parts.alias("parts"), F.lit("").alias("node"))
    ended, level = [], 0
    while True:
        below = rows.groupBy("host", "node").agg(F.sum("labelled").alias("n"))
        if (below.agg(F.max("n")).first()[0] or 0) <= MIN_LABELLED:
            break
        segment = F.get("parts", F.lit(level))
        below = rows.where(segment.isNotNull()).groupBy("host", "node", segment.alias("segment"))
        counts = below.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        nodes = counts.groupBy("host", "node").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        rest_n, rest_b = F.col("all_n") - F.col("n"), F.col("all_b") - F.col("b")
        pooled = F.col("all_b").cast("double") / F.col("all_n")
        gap = F.col("b").cast("double") / F.col("n") - rest_b.cast("double") / rest_n
        chance = Z2 * pooled * (1.0 - pooled) * (F.lit(1.0) / F.col("n") + F.lit(1.0) / rest_n)
        differs = F.when((F.col("n") >= MIN_LABELLED) & (rest_n > 0), gap * gap > chance).otherwise(F.lit(False))
        kept = counts.join(nodes, ["host", "node"]).where(differs).select(
            "host", "node", F.col("segment").alias("own"), F.lit(True).alias("stays")
        )
        rows = rows.withColumn("own", segment).join(kept, ["host", "node", "own"], "left")
        step = F.when(F.col("own").isNull(), "").when(F.col("stays"), F.concat(F.lit("/="), "own")).otherwise("/*")
        node = F.concat("node", step)
        rows = settled(rows.select("host", "shape", "labelled", "bad", "parts", node.alias("node")))
        ended.append(rows.where(F.size("parts") == level + 1))
        level += 1
        rows = rows.where(F.size("parts") > level)
    rows = together(*ended, rows.withColumn("node", F.concat("node", F.repeat(F.lit("/*"), F.size("parts") - level))))
    return rows.select("host", "shape", "labelled", "bad", F.col("node").alias("template"))


def rejected(shapes: DataFrame) -> DataFrame:
    """The (host, shape) whose template is rejected. The prior is the bad share of all labelled pages."""
    shapes = settled(shapes)
    labelled, bad = shapes.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    prior = bad / labelled if labelled else 0.0
    rows = templates(shapes)
    judged = rows.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    share = (F.col("b") + STRENGTH * prior) / (F.col("n") + STRENGTH)
    return rows.join(judged.where((F.col("n") > 0) & (share >= BAD_SHARE)).select("host", "template"), ["host", "template"]).select("host", "shape")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Key, host, path, rule and verdict of every page.

    ``labels`` has (number, bad): pages carry the number of the document they show as the first number of their path.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).withColumns({"host": host, "path": path})
    rows = rows.withColumns({
        "found": matching_rule(rules, F.col("host"), F.col("path")),
        "shape": shape(F.col("path")),
        "number": F.expr("try_cast(nullif(regexp_extract(path, '[0-9]+', 0), '') AS BIGINT)"),
    })
    known = labels.groupBy("number").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    seen = rows.select("host", "shape", "number").join(known, "number", "left")
    counted = seen.groupBy("host", "shape").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    out = settled(rejected(counted)).withColumn("out", F.lit(True))
    verdict = F.coalesce(F.col("found.action"), F.when(F.col("out"), "block").otherwise("allow"))
    return rows.join(out, ["host", "shape"], "left").select(
        F.col("key").alias(key), "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict")
    )
