"""How many clusters: silhouettes and costs of many clusterings at once.

With squared Euclidean distance, the mean distance of a point to a cluster follows from the
cluster's number of points, vector sum and sum of squares.  So one pass takes those sums for the
clusters of all clusterings, and a second one scores every point in all of them; no pairs of
points are formed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from docspark.functions import vectors as v
from docspark.operators import cluster
from docspark.operators.split import bound
from docspark.sources.staging import stage


def _assigned(df: DataFrame, assigned: dict[int, str], features: str, weight: str | None) -> DataFrame:
    """One row per point and clustering: k, cluster, point, its square, weight."""
    values = F.col(features)
    if df.schema[features].dataType.typeName() != "array":
        values = vector_to_array(values)
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("int").alias("cluster")) for k, c in assigned.items()])
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(v.doubles(values).alias("point"), own.alias("weight"), each.alias("each"))
    # The generator keeps the square from being taken again for every cluster.
    square = v.dot(F.col("point"), F.col("point")).alias("square")
    rows = rows.select("point", square, "weight", F.inline("each"))
    return rows.where("point IS NOT NULL AND cluster IS NOT NULL")


def _sums(rows: DataFrame) -> DataFrame:
    """Per clustering, its clusters with weight, vector sum and sum of squares; a few rows."""
    total = vector_to_array(Summarizer.sum(array_to_vector("point"), F.col("weight")))
    clusters = rows.groupBy("k", "cluster").agg(
        F.sum("weight").alias("size"), total.alias("total"), F.sum(F.col("weight") * F.col("square")).alias("squares")
    )
    listed = clusters.groupBy("k").agg(F.collect_list(F.struct("cluster", "size", "total", "squares")).alias("clusters"))
    # Written, so that its size is known and the points need not move to join it.
    return stage(listed, "cluster_sums")[0]


def _apart(c: Column, point: Column, square: Column) -> Column:
    """Sum of squared distances of a point to the members of a cluster."""
    return F.greatest(F.lit(0.0), c["size"] * square + c["squares"] - 2 * v.dot(point, c["total"]))


def silhouettes(
    df: DataFrame, assigned: dict[int, str], features: str = "pca_features_2d", weight: str | None = None
) -> DataFrame:
    """The mean silhouette (k, n_clusters, silhouette) of clusterings given as columns.

    ``assigned`` names the column of cluster numbers for every k; rows without a number or
    vector are left out.  ``weight`` counts copies of a point.  A point alone in its cluster
    counts 0, as does one without distance to any; with a single cluster the silhouette is null.
    """
    rows = _assigned(df, assigned, features, weight)
    sums = _sums(rows)
    return _silhouettes(rows, sums)


def _silhouettes(rows: DataFrame, sums: DataFrame) -> DataFrame:
    own = lambda c: c["cluster"] == F.col("cluster")
    distance = lambda c: _apart(c, F.col("point"), F.col("square"))
    scored = rows.join(sums, "k")
    mine = bound(F.get(F.filter("clusters", own), F.lit(0)), lambda c: F.struct(c["size"].alias("size"), distance(c).alias("inside")))
    near = F.array_min(F.transform(F.filter("clusters", lambda c: ~own(c)), lambda c: distance(c) / c["size"]))
    scored = scored.select(
        "k", "weight", mine.alias("mine"), near.alias("near"), F.size("clusters").alias("n_clusters")
    ).select("k", "weight", "mine.*", "near", "n_clusters")
    inside = F.col("inside") / (F.col("size") - 1)
    value = F.coalesce(F.try_divide(F.col("near") - inside, F.greatest("near", inside)), F.lit(0.0))
    value = F.when(F.col("n_clusters") > 1, F.when(F.col("size") > 1, value).otherwise(0.0))
    mean = F.try_divide(F.sum(value * F.col("weight")), F.sum("weight"))
    return scored.groupBy("k", "n_clusters").agg(mean.alias("silhouette"))


def costs(df: DataFrame, assigned: dict[int, str], features: str = "pca_features_2d", weight: str | None = None) -> DataFrame:
    """The cost (k, cost) of each clustering: squared distances to the means of the clusters."""
    return _costs(_sums(_assigned(df, assigned, features, weight)))


def _costs(sums: DataFrame) -> DataFrame:
    each = F.transform("clusters", lambda c: c["squares"] - v.dot(c["total"], c["total"]) / c["size"])
    return sums.select("k", F.aggregate(each, F.lit(0.0), lambda a, b: a + F.greatest(b, F.lit(0.0))).alias("cost"))


def knee(found: dict[int, float]) -> dict[int, float]:
    """The distance of every k to the chord from the first to the last one, both axes scaled to 1.

    The elbow is the k with the largest distance below the chord.
    """
    ks = sorted(found)
    wide, high = (ks[-1] - ks[0]) or 1, (found[ks[0]] - found[ks[-1]]) or 1.0
    return {k: (1 - (k - ks[0]) / wide - (found[k] - found[ks[-1]]) / high) / 2**0.5 for k in ks}


def elbow(df: DataFrame, assigned: dict[int, str], features: str = "pca_features_2d", weight: str | None = None) -> DataFrame:
    """The cost of each clustering, its distance to the chord, and which k is the elbow."""
    return _elbow(costs(df, assigned, features, weight))


def _elbow(table: DataFrame) -> DataFrame:
    found = dict(table.collect())  # one row per k
    away = knee(found) if found else {}
    best = min(away, key=lambda k: (-away[k], k), default=None)
    rows = [(k, found[k], away[k], k == best) for k in sorted(found)]
    return table.sparkSession.createDataFrame(rows, "k INT, cost DOUBLE, distance DOUBLE, is_elbow BOOLEAN")


@dataclass(frozen=True)
class Choice:
    """Scores of every k, and the best one by each rule."""

    scores: DataFrame
    by_silhouette: int
    by_elbow: int


def choose_k(
    df: DataFrame,
    ks: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8, 9, 10),
    seed: int = 1,
    column: str = "pca_features_2d",
    identity: str = "embedding",
) -> Choice:
    """Fit k-means for every k on one layout of the points, and score all fits together.

    ``scores`` has k, n_clusters, silhouette, cost, distance and is_elbow.  The best k by silhouette is
    the smallest of equal ones.
    """
    if not ks or min(ks) < 2:
        raise ValueError("k starts at 2")
    points, _ = stage(cluster.laid_out(df, column, identity), "layout")
    points = points.coalesce(cluster.FIT_PARTITIONS)
    placed, assigned = points, {}
    for k in ks:
        fit = KMeans(k=k, seed=seed, featuresCol=column, weightCol="n", predictionCol=f"_k{k}").fit(points)
        placed, assigned[k] = fit.transform(placed), f"_k{k}"
    rows = _assigned(placed, assigned, column, "n")
    sums = _sums(rows)
    both = _silhouettes(rows, sums).join(_elbow(_costs(sums)), "k")
    scores, _ = stage(both, "scores")
    best = scores.orderBy(F.desc("silhouette"), "k").first()
    return Choice(scores, best.k, scores.where("is_elbow").first().k)
