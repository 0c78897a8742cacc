"""Shards of near equal bytes by sampled splitters.

A sample drawn in proportion to size gives quantiles of the key, which cut all records into many more ranges than
shards. Ranges are then counted exactly, and a record's shard follows from the bytes that lie before it. The key is a
hash of the text, so equal texts lie next to each other and share a shard. A text with so many copies that a range of
it would be overfull is subdivided by id.

Null texts count as empty, null ids sort first. Empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import filled, fresh, uniform
from clicklake.sources.files import settled

RANGES_PER_SHARD = 16
SAMPLES_PER_RANGE = 64
#: A group of equal texts up to this part of a shard stays whole.
WHOLE_GROUP = 64


def records(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Id, size, checksum and range key of every row: all that sharding needs. With ``carry`` also the ``whole_row``."""
    whole = filled(F.col(text))
    return docs.select(
        *([F.struct(*[F.col(c) for c in docs.columns]).alias("whole_row")] if carry else []),
        F.col(key).alias("id"),
        (F.octet_length(whole) + 8).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("crc"),
        F.xxhash64(whole).alias("k"),
    )


def sampled_splitters(rows: DataFrame, n_ranges: int) -> tuple[list[int], dict[int, list[int]]]:
    """Quantile boundaries of the key, and for overfull keys boundaries of the id.

    About ``n_ranges * SAMPLES_PER_RANGE`` samples reach the driver, whatever the input's size. A record weighs its
    size plus the mean size: ranges then hold neither too many bytes nor too many rows.
    """
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not n:
        return [], {}
    mean = total / n
    share = n_ranges * SAMPLES_PER_RANGE / (total + n * mean)
    drawn = F.floor((F.col("size") + mean) * share + uniform(F.col("id"), F.col("k"), F.lit(7)))
    sample = rows.select("k", "id", drawn.alias("n")).where("n > 0").collect()
    sample.sort(key=lambda r: (r["k"], r["id"] is not None, r["id"] or 0))
    cuts: dict[int, list[int | None]] = {}
    seen, due = 0, SAMPLES_PER_RANGE
    for k, i, n in sample:
        seen += n
        if seen >= due:
            cuts.setdefault(k, []).append(i)
            due = seen + SAMPLES_PER_RANGE
    overfull = {k: sorted({i for i in ids if i is not None}) for k, ids in cuts.items() if len(ids) > 1}
    # What follows an overfull key starts a range of its own.
    keys = sorted(set(cuts) | {k + 1 for k in overfull if k + 1 < 1 << 63})
    return keys, overfull


def _at_or_below(bounds: list[int], value: Column) -> Column:
    """How many of the sorted bounds are at or below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    further = lambda low, step: F.when(F.get(array, low + step - 1) <= value, low + step).otherwise(low)
    return F.aggregate(steps, F.lit(0), further)


def in_ranges(rows: DataFrame, keys: list[int], overfull: dict[int, list[int]]) -> DataFrame:
    """Adds ``part`` and ``piece``, whose order is that of (key, id), and ``hot`` for overfull keys."""
    piece, hot = F.lit(0), F.lit(False)
    for k, ids in overfull.items():
        piece = F.when(F.col("k") == k, _at_or_below(ids, F.col("id"))).otherwise(piece)
        hot = hot | (F.col("k") == k)
    return rows.withColumns({"part": _at_or_below(keys, F.col("k")), "piece": piece, "hot": hot})


def assign(rows: DataFrame, n_shards: int) -> DataFrame:
    """Shard and slot for each of the ``records``; slots are gapless from 0 in each shard, in the order of (key, id).

    A carried row comes along.
    """
    carried = [c for c in rows.columns if c == "whole_row"]
    n_ranges = n_shards * RANGES_PER_SHARD
    ranged = settled(in_ranges(rows, *sampled_splitters(rows, n_ranges)))
    # At most three ranges per quantile: one row each.
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("part", "piece").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    starts = ranges.select(
        "part", "piece",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    own = Window.partitionBy("part", "piece").orderBy("k", "id")
    group = Window.partitionBy("part", "piece", "k")
    up_to = own.rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumns({
        "row": F.row_number().over(own) - 1,
        "end": F.sum("size").over(up_to),
        "group_size": F.sum("size").over(group),
    })
    first = Window.partitionBy("part", "piece", "k")
    placed = placed.withColumn("group_start", F.min(F.col("end") - F.col("size")).over(first))
    placed = placed.join(F.broadcast(starts), ["part", "piece"])
    whole = ~F.col("hot") & (F.col("group_size") * n_shards * WHOLE_GROUP <= F.col("total"))
    start = F.when(whole, F.col("group_start")).otherwise(F.col("end") - F.col("size"))
    unit = F.when(whole, F.col("group_size")).otherwise(F.col("size"))
    # The middle of the unit decides: twice its distance from the start, over twice the total.
    middle = 2 * (F.col("bytes_before") + start) + unit
    shard = F.least(F.lit(n_shards - 1), F.expr(f"({n_shards} * m) div (2 * total)")).cast("int")
    placed = settled(
        placed.withColumn("m", middle).select(
            *carried, "id", "size", "crc", shard.alias("shard"), (F.col("rows_before") + F.col("row")).alias("rank")
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        *carried, "id", "size", "crc", "shard", (F.col("rank") - F.col("first")).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int, key: str = "doc_id", text: str = "text") -> tuple[str, str]:
    """The rows, all of them and with all their columns, as one folder per shard, sorted by slot within each file.

    Returns the names of the columns for shard and slot, which are others than ``shard`` and ``slot`` where those exist.
    Rows travel with their record, so repeated and missing ids make no difference.
    """
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    placed = assign(records(docs, key, text, carry=True), n_shards)
    named = placed.select(*[F.col("whole_row")[c].alias(c) for c in docs.columns], F.col("shard").alias(shard), F.col("slot").alias(slot))
    named.hint("rebalance", shard).sortWithinPartitions(shard, slot).write.mode("overwrite").partitionBy(shard).parquet(path)
    return shard, slot
