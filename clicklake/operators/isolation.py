"""Anomaly scores by an isolation forest.

Each tree is grown from a sample of rows that a hash picks, level by level: a node's rows are split at a random point of
a random feature until they are alone, alike, or as deep as the sample's depth allows. All trees grow together as one
table of at most ``trees * sample`` rows, and so the forest is small whatever the table's size. Scoring sends that
forest to the tasks, which walk a batch of rows through a tree at a time as arrays, and shuffles no rows. Rows that are
told apart after few splits score near 1.

Null features count as the feature's least value. Equal rows get equal scores; the same table gets the same forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clicklake.sources.files import settled

TREES, SAMPLE, CONTAMINATION = 100, 256, 0.1
_EULER = 0.5772156649015329


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def mean_depth(n: Column) -> Column:
    """Of a search in a random tree of ``n`` rows that finds nothing."""
    more = 2.0 * (F.ln(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n
    return F.when(n > 2, more).when(n == 2, F.lit(1.0)).otherwise(F.lit(0.0))


def sampled(df: DataFrame, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, f): about ``sample`` rows for each tree, of rows (row, f) whose ``row`` tells them apart."""
    share = trees * sample / max(df.count(), 1)
    # Where the trees want more rows than there are, a row is drawn for several trees.
    times = max(1, math.ceil(share))
    each = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    taken = each.where(_uniform(F.col("row"), F.col("copy"), F.lit(seed)) < share / times)
    tree = F.pmod(F.xxhash64("row", "copy", F.lit(seed + 1)), F.lit(trees)).cast("int")
    return taken.select(tree.alias("tree"), "f")


def grown(samples: DataFrame, n_features: int, depth: int, seed: int) -> DataFrame:
    """(tree, node, feature, split, size) of all nodes; a leaf has no feature. The root is 1, children of n are 2n and 2n+1."""
    rows, nodes = settled(samples.withColumn("node", F.lit(1))), None
    for level in range(depth + 1):
        ends = rows.groupBy("tree", "node").agg(
            F.count("*").alias("size"), F.array(*[F.min(F.get("f", F.lit(i))) for i in range(n_features)]).alias("low"),
            F.array(*[F.max(F.get("f", F.lit(i))) for i in range(n_features)]).alias("high"),
        )
        open_ = F.filter(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda i: F.get("low", i) < F.get("high", i))
        turn = F.pmod(F.xxhash64("tree", "node", F.lit(seed + 2)), F.size("open")).cast("int")
        split = ends.withColumn("open", open_ if level < depth else F.array().cast("array<int>"))
        split = split.withColumn("feature", F.when(F.size("open") > 0, F.get("open", turn)))
        low, high = F.get("low", F.col("feature")), F.get("high", F.col("feature"))
        point = low + _uniform(F.col("tree"), F.col("node"), F.lit(seed + 3)) * (high - low)
        own = settled(split.select("tree", "node", "feature", F.when(F.col("feature").isNotNull(), point).alias("split"), "size"))
        nodes = own if nodes is None else nodes.union(own)
        right = (F.get("f", F.col("feature")) > F.col("split")).cast("int")
        parted = rows.join(own.where("feature IS NOT NULL").drop("size"), ["tree", "node"])
        rows = settled(parted.select("tree", "f", (2 * F.col("node") + right).alias("node")))
        if rows.isEmpty():
            break
    return nodes


class Forest:
    """All trees as arrays, a node at its number. A leaf is its own left child, and nothing lies right of it."""

    def __init__(self, nodes: Iterable[tuple], depth: int) -> None:
        nodes = list(nodes)
        self.depth, self.numbers = depth, {tree: i for i, tree in enumerate(sorted({n[0] for n in nodes}))}
        shape = len(self.numbers), 2 ** (depth + 1)
        self.feature, self.split = np.zeros(shape, np.int64), np.full(shape, np.nan)
        self.child, self.end = np.tile(np.arange(shape[1]), (shape[0], 1)), np.zeros(shape)
        for tree, node, feature, split, left in nodes:
            at = self.numbers[tree], node
            self.end[at] = node.bit_length() - 1 + left
            if feature is not None:
                self.feature[at], self.split[at], self.child[at] = feature, split, 2 * node

    def mean_depths(self, x: np.ndarray) -> np.ndarray:
        """Of rows that are the columns of ``x``; a number that is none lies right of every other."""
        x = np.ascontiguousarray(x, float)
        total, rows, flat = np.zeros(x.shape[1]), np.arange(x.shape[1]), x.ravel()
        odd = np.isnan(flat).any()
        for feature, split, child, end in zip(self.feature * x.shape[1], self.split, self.child, self.end):
            node = np.ones(x.shape[1], np.int64)
            for _ in range(self.depth):
                value, border = flat[feature[node] + rows], split[node]
                right = value > border
                if odd:
                    right |= np.isnan(value) & ~np.isnan(border)
                node = child[node] + right
            total += end[node]
        return total / max(len(self.numbers), 1)


def _fresh(df: DataFrame) -> str:
    """A column name that the frame does not use yet."""
    name, taken = "_mean", {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def anomaly_scores(
    df: DataFrame, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE, contamination: float = CONTAMINATION, seed: int = 1,
) -> DataFrame:
    """All columns plus ``score`` (0 to 1) and ``outlier``, 1 for about the highest ``contamination`` of all rows."""
    depth = math.ceil(math.log2(sample))
    least = df.agg(*[F.coalesce(F.min(F.col(f).cast("double")), F.lit(0.0)).alias(f) for f in features]).first()
    values = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(least[f])) for f in features])
    rows = df.select(F.xxhash64(*df.columns).alias("row"), values.alias("f"))
    nodes = grown(sampled(rows, trees, sample, seed), len(features), depth, seed)
    # At most trees * 2 * sample nodes, whatever the table's size.
    known = nodes.withColumn("left", mean_depth(F.col("size").cast("double"))).collect()
    forest = Forest([(r["tree"], r["node"], r["feature"], r["split"], r["left"]) for r in known], depth)
    sizes = [r["size"] for r in known if r["node"] == 1]
    size = max(sum(sizes) / len(sizes) if sizes else 2, 3)
    usual = 2.0 * (math.log(size - 1.0) + _EULER) - 2.0 * (size - 1.0) / size
    mean, place = _fresh(df), len(df.columns)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(place).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            result = pa.array(shared.value.mean_depths(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], result], names=[*batch.schema.names[:place], mean])

    walked = df.withColumn(mean, values).mapInArrow(run, df.withColumn(mean, F.lit(0.0)).schema)
    scored = settled(walked.withColumn("score", F.pow(F.lit(2.0), -F.col(mean) / usual)).drop(mean))
    bound = scored.agg(F.percentile_approx("score", 1.0 - contamination, 10_000)).first()[0]
    return scored.withColumn("outlier", (F.col("score") > F.lit(bound)).cast("int"))
