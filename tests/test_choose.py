"""Silhouettes and costs against Spark's evaluator and pairwise sums."""

import math
import random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from docspark.operators import choose

SCHEMA = "point array<double>, a int, b int, n long"


def points(n=60, seed=0):
    rnd = random.Random(seed)
    rows = [([rnd.gauss(5 * (i % 3), 1), rnd.gauss(0, 1), rnd.random()], i % 3, rnd.randrange(5), rnd.randint(1, 4)) for i in range(n)]
    return rows + [([9.0, 9.0, 9.0], 1, 7, 1)]


def pairwise(rows, cluster):
    """The definition, with every copy a point of its own."""
    every = [(p, c[cluster]) for p, *c, n in rows for _ in range(n)]
    total = 0.0
    for i, (p, c) in enumerate(every):
        sums = {}
        for j, (q, d) in enumerate(every):
            if i != j:
                sums.setdefault(d, []).append(math.dist(p, q) ** 2)
        if c in sums:
            inside, near = sum(sums[c]) / len(sums[c]), min(sum(v) / len(v) for d, v in sums.items() if d != c)
            total += (near - inside) / max(near, inside) if max(near, inside) else 0.0
    return total / len(every)


def test_silhouettes_are_those_of_the_evaluator(spark):
    df = spark.createDataFrame(points(), SCHEMA)
    found = {r.k: r.silhouette for r in choose.silhouettes(df, {3: "a", 6: "b"}, "point").collect()}
    vectors = df.withColumn("features", array_to_vector("point"))
    for k, column in ((3, "a"), (6, "b")):
        expected = ClusteringEvaluator(predictionCol=column).evaluate(vectors)
        assert found[k] == pytest.approx(expected, abs=1e-9)


def test_weights_count_copies(spark):
    rows = points(30, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.k: r.silhouette for r in choose.silhouettes(df, {3: "a", 6: "b"}, "point", "n").collect()}
    assert found == pytest.approx({3: pairwise(rows, 0), 6: pairwise(rows, 1)}, abs=1e-9)


def test_copies_one_cluster_and_missing_rows(spark):
    rows = [([1.0, 1.0, 1.0], 0, i % 2, 1) for i in range(6)] + [(None, 0, 0, 1), ([2.0, 0.0, 0.0], None, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.k: (r.n_clusters, r.silhouette) for r in choose.silhouettes(df, {1: "a", 2: "b"}, "point").collect()}
    assert found == {1: (1, None), 2: (2, 0.0)}
    assert choose.silhouettes(df.limit(0), {2: "b"}, "point").collect() == []
    assert choose.elbow(df.limit(0), {2: "b"}, "point").collect() == []


def test_costs(spark):
    rows = points(40, 2)
    found = dict(choose.costs(spark.createDataFrame(rows, SCHEMA), {3: "a"}, "point").collect())
    expected = 0.0
    for c in range(3):
        own = [p for p, a, *_ in rows if a == c]
        center = [sum(x) / len(own) for x in zip(*own)]
        expected += sum(math.dist(p, center) ** 2 for p in own)
    assert found == {3: pytest.approx(expected)}


def test_the_knee_is_farthest_below_the_chord():
    away = choose.knee({1: 100.0, 2: 50.0, 3: 12.0, 4: 10.0, 5: 9.0})
    assert max(away, key=away.get) == 3 and away[1] == away[5] == 0
    assert choose.knee({4: 3.0}) == {4: pytest.approx(2**-0.5)}


def test_three_groups_are_found(spark):
    rnd = random.Random(4)
    rows = [([rnd.gauss(10 * (i % 3), 0.5), rnd.gauss(10 * (i % 2), 0.5)],) for i in range(120)]
    df = spark.createDataFrame(rows, "embedding array<double>").withColumn("pca_features_2d", array_to_vector("embedding"))
    choice = choose.choose_k(df, (2, 3, 6, 8))
    assert choice.by_silhouette == 6
    assert [(r.k, r.n_clusters) for r in choice.scores.orderBy("k").collect()] == [(k, k) for k in (2, 3, 6, 8)]
    assert choice.scores.where(F.col("is_elbow")).count() == 1
    with pytest.raises(ValueError):
        choose.choose_k(df, (1, 2))
