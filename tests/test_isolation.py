"""Isolation forests: scores against a walk in plain Python, planted outliers, odd rows."""

from __future__ import annotations

import math
import random

import numpy as np

from clicklake.operators import isolation


def mean_depth(n):
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def points(spark, n=600, odd=6):
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 1), rng.gauss(5, 2)) for i in range(n)]
    rows += [(n + k, rng.choice([-1.0, 1.0]) * (9 + k), rng.choice([-12.0, 25.0]) + k) for k in range(odd)]
    return spark.createDataFrame(rows, "id long, x double, y double"), n


def test_planted_outliers_rank_first(spark):
    df, n = points(spark)
    got = isolation.anomaly_scores(df, ["x", "y"], trees=60, sample=128)
    assert got.columns == ["id", "x", "y", "score", "outlier"]
    rows = sorted(got.collect(), key=lambda r: -r.score)
    assert {r.id for r in rows[:6]} == set(range(n, n + 6))
    assert 0.05 < sum(r.outlier for r in rows) / len(rows) < 0.11 and all(0 < r.score < 1 for r in rows)


def test_scores_are_those_of_a_plain_walk(spark, monkeypatch):
    kept = []
    grow = isolation.grown
    monkeypatch.setattr(isolation, "grown", lambda *a: kept.append(grow(*a)) or kept[-1])
    df, _ = points(spark, 300)
    got = isolation.anomaly_scores(df, ["x", "y"], trees=9, sample=64).collect()
    nodes = {(r.tree, r.node): r for r in kept[0].collect()}
    trees = sorted({t for t, _ in nodes})
    # Children share out their parent's rows.
    for (t, k), r in nodes.items():
        if r.feature is not None:
            assert nodes[t, 2 * k]["size"] + nodes[t, 2 * k + 1]["size"] == r["size"] and k < 64
    usual = mean_depth(max(3, sum(nodes[t, 1]["size"] for t in trees) / len(trees)))
    for r in got:
        total = 0.0
        for t in trees:
            k = 1
            while nodes[t, k].feature is not None:
                k = 2 * k + ((r.x, r.y)[nodes[t, k].feature] > nodes[t, k].split)
            total += math.floor(math.log2(k)) + mean_depth(nodes[t, k]["size"])
        assert math.isclose(r.score, 2 ** (-total / len(trees) / usual), rel_tol=1e-9)


def test_nulls_equal_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, None, 2.0), (2, 1.0, None), (3, 1.0, 2.0)], "id long, x double, y double")
    got = isolation.anomaly_scores(df, ["x", "y"], trees=5, sample=8).collect()
    assert len(got) == 4 and len({r.score for r in got if r.id == 1}) == 1
    assert isolation.anomaly_scores(df.limit(0), ["x", "y"], trees=5, sample=8).count() == 0
    same = spark.createDataFrame([(i, 1.0) for i in range(50)], "id long, x double")
    assert len({r.score for r in isolation.anomaly_scores(same, ["x"], trees=5, sample=8).collect()}) == 1


def test_forest_of_arrays_walks_like_its_nodes():
    """Borders go left, numbers that are none go right of all others, leaves keep their rows."""
    nodes = [(4, 1, 0, 2.0, 0.0), (4, 2, None, None, 0.5), (4, 3, 1, 0.0, 0.0), (4, 6, None, None, 0.0), (4, 7, None, None, 2.0), (9, 1, None, None, 3.0)]
    forest = isolation.Forest(nodes, 3)
    x = np.array([[2.0, 2.5, 2.5, math.nan, 1.0], [9.0, 0.0, math.nan, math.inf, math.nan]])
    assert forest.mean_depths(x).tolist() == [(d + 3.0) / 2 for d in (1.5, 2.0, 4.0, 4.0, 1.5)]
    assert isolation.Forest([], 3).mean_depths(x).tolist() == [0.0] * 5
