"""Mixing sources to target weights by systematic sampling.

The expected number of copies of a document is its source's target over its source's size. Within a source, documents
are laid out one after the other, each as long as its expected copies, and the whole is shifted by one random offset: a
document is emitted once for each whole number that falls into its stretch. Documents of like length are neighbours, so
that each length gets its share of copies and the words taken stay near the target.

All documents of a source expect the same number of copies, so the sum before a document is its rank times that
number, and ranks are whole numbers: the result does not depend on partitions. Ranks come from blocks of a source
(length class, range of a hash), counted first, so a hot source is ranked by many tasks.

Null texts have size 0, a null source is a source of its own and the last. Sources without words take nothing. Rows
without an id, and those of an id that very many rows share, are placed by a hash of all their columns instead of their
id; rows that are equal in all columns are neighbours and are ranked in one task. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import fresh, hash52
from clicklake.sources.files import settled

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix-1"
BLOCK_ROWS = 1_000_000
#: What is added to the rows: the words of a row's source, the words it should give, and the copies of the row.
MIXED = ("mix_source_size", "mix_target", "mix_copies")


def length_class(size: Column) -> Column:
    """Sortable class of sizes within an eighth of each other, in whole numbers."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4))


def targets(sources: DataFrame) -> DataFrame:
    """The words that each source gives, for one row (source, source_size) per source.

    All targets together are all words. A source's part follows its weight, up to ``MOST_COPIES`` times its size; what
    lies above goes to the others by weight. Sources are few next to documents, one row each, so one task orders them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (turn + 1).cast("int"))
    whole = F.col("source_size").cast("decimal(38,0)")
    rows = sources.withColumns({"weight": weight, "cap": whole * MOST_COPIES}).withColumn("w", F.col("weight").cast("long"))
    # Sources reach their caps in the order of cap over weight, which times six is whole.
    ratio = F.expr("cap * (6 div w)")
    rows = rows.withColumn("ratio", ratio)
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum(whole).over(everything)
    rows = rows.withColumns({
        "total": total,
        "weights": F.sum("w").over(everything),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "w_before": F.coalesce(F.sum("w").over(before), F.lit(0)),
    })
    rows = rows.withColumn("capped", F.expr("(total - cap_before) * w > cap * (weights - w_before)"))
    rows = rows.withColumns({
        "free": F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)),
        "free_w": F.col("weights") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("w"))).over(everything), F.lit(0)),
    })
    level = F.col("free").cast("double") * F.col("w").cast("double") / F.col("free_w").cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level)
    return rows.select("source", "source_size", target.alias("target"))


def names_for(docs: DataFrame) -> tuple[str, str, str]:
    """Names for what :func:`mix` adds that the frame does not use yet."""
    return tuple(fresh(docs, name) for name in MIXED)


def mix(
    docs: DataFrame, size: str, key: str = "doc_id", source: str = "source", seed: str = SEED, names: Sequence[str] = MIXED
) -> DataFrame:
    """All columns plus a source's size and target and a row's copies, under ``names``, which must be new ones.

    Reads ``docs`` three times: for ids that many rows have, to count blocks, and to rank within them.
    """
    if any(fresh(docs, n) != n for n in names):
        raise ValueError(f"one of the columns {', '.join(names)} exists already")
    source_size, target, copies_ = names
    name = lambda part: fresh(docs, f"__mix_{part}")
    cls, at, block = name("class"), name("hash"), name("block")
    blocks_per_class = -(-docs.count() // BLOCK_ROWS) or 1
    # Rows without an id, or with one that more rows have than a task should rank, are placed by what they hold. There
    # are no more such ids than the table has multiples of that number.
    often = docs.groupBy(F.col(key).alias("key")).count().where(F.col("count") > BLOCK_ROWS).select("key").collect()
    often = [r["key"] for r in often if r["key"] is not None]
    by_content = F.col(key).isNull() | (F.col(key).isin(often) if often else F.lit(False))
    content = F.xxhash64(*[F.col(c) for c in docs.columns])
    place = F.when(by_content, hash52(F.lit(seed), content)).otherwise(hash52(F.lit(seed), F.col(key)))
    rows = docs.withColumns({cls: length_class(F.col(size)), at: place})
    # The blocks are ranges of the hash: the order (class, hash, id) does not depend on their number.
    rows = rows.withColumn(block, F.floor(F.col(at).cast("double") * blocks_per_class / float(1 << 52)).cast("int"))
    blocks = settled(
        rows.groupBy(F.col(source).alias("source"), F.col(cls).alias("cls"), F.col(block).alias("block"))
        .agg(F.sum(size).cast("long").alias("size"), F.count("*").alias("n"))
    )
    aims = targets(blocks.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")))
    before = Window.partitionBy("source").orderBy("cls", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("source", "cls", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_before"))
    named = aims.withColumnRenamed("source", "aim_source")
    starts = settled(starts.join(named, F.col("source").eqNullSafe(F.col("aim_source"))).drop("aim_source"))
    s_, c_, b_, rank_ = (name(part) for part in ("s", "c", "b", "rank"))
    starts = starts.toDF(s_, c_, b_, rank_, source_size, target)
    order = Window.partitionBy(source, cls, block).orderBy(at, key)
    row = name("row")
    ranked = rows.withColumn(row, F.row_number().over(order))
    on = F.col(source).eqNullSafe(F.col(s_)) & (F.col(cls) == F.col(c_)) & (F.col(block) == F.col(b_))
    out = ranked.join(starts, on)
    rate = F.col(target) / F.nullif(F.col(source_size), F.lit(0)).cast("double")
    # 16 bits of offset keep the sums below exact for far more documents than a source has.
    offset = F.floor(hash52(F.lit(f"{seed}-offset"), F.col(source)).cast("double") / float(1 << 36)) / float(1 << 16)
    up_to = lambda rank: F.floor(rate * rank.cast("double") + offset)
    rank = F.col(rank_) + F.col(row)
    copies = F.least(up_to(rank) - up_to(rank - 1), F.ceil(rate))
    out = out.withColumn(copies_, F.coalesce(copies, F.lit(0)).cast("int"))
    return out.drop(cls, at, block, row, s_, c_, b_, rank_)


def emitted(mixed: DataFrame, names: Sequence[str] = MIXED) -> DataFrame:
    """One row per copy, without the columns that :func:`mix` added."""
    n = fresh(mixed, "__copy")
    copies = F.sequence(F.lit(1), F.col(names[2]))
    out = mixed.where(F.col(names[2]) > 0).withColumn(n, F.explode(copies))
    return out.drop(n, *names)
