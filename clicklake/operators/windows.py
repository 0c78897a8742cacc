"""Window results that survive hot keys.

A window over a key puts all rows of that key into one task. Keys such as a null
cookie or a robot may hold a third of a table; the rows of such a key are
windowed in slices, and one small row per slice carries over what the next needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.operators.joins import null_safe_join
from clicklake.operators.skew import HOT_ROWS, split_hot, together
from clicklake.sources.files import settled


#: Slices of hot keys hold about so many rows at least.
LEAST_SLICE = 10_000


def lag_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, hot_rows: int = HOT_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """``lag(value)`` per key, in ``order``.

    Keys with more than ``hot_rows`` rows are windowed in slices of about ``slice_rows`` rows (by default
    ``hot_rows``, but ``LEAST_SLICE`` at least). ``order`` should be unique per key; ties are cut arbitrarily, as in
    any lag, and rows that tie in all of ``order`` share a slice.
    """
    ordinary, hot = split_hot(df, keys, hot_rows)
    if ordinary is not None:
        ordinary = ordinary.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    if hot is not None:
        hot = _lag_in_slices(slices(hot, keys, order, slice_rows or max(hot_rows, LEAST_SLICE)), keys, order, value, out)
    return together(ordinary, hot)


def slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int) -> DataFrame:
    """All rows with a ``_slice`` that ascends along ``keys`` and ``order``.

    The slices are ranges that Spark draws from a sample of the rows, so they hold about as many rows each however
    the rows lie in time. They are written once: computed anew, ranges might fall otherwise.
    """
    n = max(2, -(-df.count() // slice_rows))
    ranged = df.repartitionByRange(n, *keys, *order)
    return settled(ranged.withColumn("_slice", F.spark_partition_id()))


def _lag_in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """The last value of a slice enters the key's next slice as an extra first row.

    The rows themselves are shuffled once, by key and slice. Of a key, only one
    row per slice meets in one task.
    """
    rows = df.withColumn("_carried", F.lit(False))
    last = rows.groupBy(*keys, "_slice").agg(F.max_by(value, F.struct(*order)).alias(value))
    next_slice = F.lead("_slice").over(Window.partitionBy(*keys).orderBy("_slice"))
    carried = (
        last.withColumn("_slice", next_slice)
        .where(F.col("_slice").isNotNull())
        .withColumn("_carried", F.lit(True))
    )
    window = Window.partitionBy(*keys, "_slice").orderBy(F.desc("_carried"), *order)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.lag(value).over(window))
        .where(~F.col("_carried"))
        .drop("_slice", "_carried")
    )


def with_group_totals(df: DataFrame, totals: Mapping[tuple[str, ...], Sequence[Column]]) -> DataFrame:
    """Aggregates over whole groups next to every row: ``{group columns: aggregates}``.

    Each aggregate is combined before its shuffle, and the join back can split a
    hot group, which a window over the group could not.
    """
    result = df
    for keys, aggregates in totals.items():
        result = null_safe_join(result, df.groupBy(*keys).agg(*aggregates), keys)
    return result
