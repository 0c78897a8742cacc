"""Templates filled from key/value rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clicklake.functions.text import replace_literal


def fill_templates(
    df: DataFrame, ids: Sequence[str], keep: Sequence[str], template: str, order: str, key: str, value: str,
    steps: int | None = None,
) -> DataFrame:
    """Templates of row 1 of each record with the keys of its rows replaced in turn, from row 1 on.

    ``steps`` ends that early. Where several rows share a number, every choice of one of them gives a result, as a
    join per number would. A record's rows meet in one shuffle, whatever their number; empty results go.
    """
    numbered = df.where(F.col(order) >= 1)
    if steps is not None:
        numbered = numbered.where(F.col(order) <= steps)
    pair = F.struct(F.col(order).alias("at"), F.col(key).alias("key"), F.col(value).alias("value"))
    first = F.when(F.col(order) == 1, F.struct(F.col(template).alias("text"), F.col(key).alias("key"), F.col(value).alias("value")))
    whole = numbered.groupBy(*ids).agg(F.collect_set(pair).alias("pairs"), F.collect_set(first).alias("starts"))
    replaced = lambda text, p: replace_literal(text, p["key"], p["value"])
    begun = F.transform("starts", lambda s: replaced(s["text"], s))
    numbers = F.array_sort(F.array_distinct(F.transform(F.filter("pairs", lambda p: p["at"] > 1), lambda p: p["at"])))

    def step(texts, number):
        own = F.filter(F.col("pairs"), lambda p: p["at"] == number)
        return F.array_distinct(F.flatten(F.transform(own, lambda p: F.transform(texts, lambda t: replaced(t, p)))))

    filled = whole.select(*ids, F.explode(F.aggregate(numbers, begun, step)).alias("filled"))
    return filled.where(F.length("filled") > 0).select(*keep, "filled").distinct()
