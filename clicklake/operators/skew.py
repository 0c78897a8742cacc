"""Telling hot groups from ordinary ones.

A window needs all rows of a group in one task. That is the cheapest plan for
ordinary groups, and no plan at all for a key that holds a third of a table. So
groups are counted first, which costs one narrow, pre-aggregated pass; ordinary
ones keep the plain window, and the few hot ones take a way that splits them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.operators.joins import null_safe_join
from clicklake.sources.files import settled

HOT_ROWS = 1_000_000


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, measures: Sequence[Column] = ()
) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of ordinary groups, rows of groups with more than ``hot_rows`` rows); None for a part without groups.

    There can be no more hot groups than the table has multiples of
    ``hot_rows``, so their list stays small whatever the keys are. With
    ``hot_rows=0`` every group is hot. Hot rows get the ``measures`` of their
    group, aggregates that the counting pass takes along.
    """
    if hot_rows <= 0 and not measures:
        return None, df
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), *measures)
    hot = settled(counted.where(F.col("_n") > hot_rows).drop("_n"))
    if hot.isEmpty():
        return df, None
    ordinary = null_safe_join(df, hot, keys, "left_anti") if hot_rows > 0 else None
    return ordinary, null_safe_join(df, hot, keys, "inner" if measures else "left_semi")


def together(*parts: DataFrame | None) -> DataFrame:
    """Union of the parts that exist."""
    first, *others = [part for part in parts if part is not None]
    for other in others:
        first = first.unionByName(other)
    return first
