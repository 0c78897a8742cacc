"""Aggregations. All of them combine rows before they shuffle, so hot groups stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per group, largest group first."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys)


def distinct_values(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns).distinct()


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias(ts))


def distinct_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, count): distinct values of each column in one pass; null counts as a value."""
    counts = df.agg(
        *[
            (F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(c)
            for c in columns
        ]
    )
    return counts.unpivot([], list(columns), "field", "count")


def pivot_counts(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows per key value, spread over one column per value, zero where there are none.

    The values are given, so no pass over the data has to find them.
    """
    return df.groupBy(key).pivot(key, list(values)).count().na.fill(0)
