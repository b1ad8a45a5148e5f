"""Scaling, reduction, clustering and outlier flags on embeddings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from docspark.functions import vectors as v
from docspark.operators.embed import with_vector
from docspark.params import Params
from docspark.sources.staging import stage

# Partitions of the narrow table that k-means iterates over; the start points depend on it.
FIT_PARTITIONS = 16


def fit_scaler(
    df: DataFrame, column: str = "embedding_vector", into: str = "scaled_embedding"
) -> StandardScalerModel:
    """Divide by the sample standard deviation, without centering."""
    return StandardScaler(withStd=True, withMean=False, inputCol=column, outputCol=into).fit(df)


def fit_pca(
    df: DataFrame,
    components: int = 50,
    column: str = "scaled_embedding",
    into: str = "pca_features_50",
) -> PCAModel:
    """Principal components; never more than the vectors have dimensions."""
    first = df.select(F.size(vector_to_array(column)).alias("dim")).first()
    if first is None:
        raise ValueError("no vectors to reduce")
    return PCA(k=min(components, first.dim), inputCol=column, outputCol=into).fit(df)


def first_two(
    df: DataFrame, column: str = "pca_features_50", into: str = "pca_features_2d"
) -> DataFrame:
    """The two leading components.

    Reducing a principal-component space again gives its first axes back (up to sign),
    so a slice replaces a second fit.
    """
    return df.withColumn(into, array_to_vector(F.slice(vector_to_array(column), 1, 2)))


def laid_out(
    df: DataFrame,
    column: str = "pca_features_2d",
    identity: str = "embedding",
    partitions: int = FIT_PARTITIONS,
) -> DataFrame:
    """Two-dimensional points (``column``, weight ``n``) in an order of their own.

    Copies are counted first (128 hash bits of ``identity`` name a point, combined per
    task) and become one weighted point, so a large group of copies is one row.  Start
    points depend on which rows share a partition; the layout therefore follows a rule
    that is the same at every size: ``partitions`` of them, a hash, a sort.
    """
    xy = vector_to_array(column)
    points = (
        df.select(
            F.xxhash64(identity).alias("h1"),
            F.xxhash64(identity, F.lit(1)).alias("h2"),
            xy[0].alias("x"),
            xy[1].alias("y"),
        )
        .groupBy("h1", "h2")
        .agg(F.first("x").alias("x"), F.first("y").alias("y"), F.count(F.lit(1)).alias("n"))
    )
    points, _ = stage(points, "points")
    ordered = points.repartition(partitions, "h1", "h2").sortWithinPartitions("h1", "h2")
    return ordered.select(array_to_vector(F.array("x", "y")).alias(column), F.col("n").cast("double").alias("n"))


def fit_kmeans(
    df: DataFrame,
    k: int = 7,
    seed: int = 1,
    column: str = "pca_features_2d",
    identity: str = "embedding",
    partitions: int = FIT_PARTITIONS,
) -> KMeansModel:
    """K-means on the two-dimensional points, the same on every cluster."""
    points = laid_out(df, column, identity, partitions)
    return KMeans(k=k, seed=seed, featuresCol=column, weightCol="n").fit(points)


def center_table(model: KMeansModel, like: DataFrame) -> DataFrame:
    """The centers as a table ``prediction, center``."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return like.sparkSession.createDataFrame(rows, "prediction INT, center ARRAY<DOUBLE>")


def mean_centers(
    df: DataFrame, cluster: str = "prediction", embedding: str = "embedding"
) -> DataFrame:
    """The mean vector of each cluster, pre-aggregated per task."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(v.doubles(F.col(embedding)))))
    return df.groupBy(cluster).agg(mean.alias("center"))


def _join_clusters(df: DataFrame, side: DataFrame, few: bool) -> DataFrame:
    return df.join(F.broadcast(side) if few else side, "prediction")


def center_distance(
    df: DataFrame,
    centers: DataFrame,
    features: str = "pca_features_2d",
    *,
    few: bool = False,
) -> DataFrame:
    """Add ``distance_to_center``, the Euclidean distance to the row's own center.

    ``features`` is an ML vector or a number array.  ``few`` says that the centers are those
    of a fitted model, which are few; otherwise the join is left to the adaptive planner.
    """
    values = F.col(features)
    if df.schema[features].dataType.typeName() != "array":
        values = vector_to_array(values)
    distance = v.euclidean(v.doubles(values), F.col("center")).cast("float")
    joined = _join_clusters(df, centers, few)
    return joined.withColumn("distance_to_center", distance).drop("center")


def cluster_stats(df: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the distance per cluster."""
    return df.groupBy("prediction").agg(
        F.mean("distance_to_center").alias("mean_dist"),
        F.stddev_samp("distance_to_center").alias("std_dist"),
    )


def flag_outliers(df: DataFrame, stds: float = 2.0, *, few: bool = False) -> DataFrame:
    """Add the cluster statistics and ``is_outlier``; a cluster of one has no flag."""
    limit = F.col("mean_dist") + F.lit(stds) * F.col("std_dist")
    joined = _join_clusters(df, cluster_stats(df), few)
    return joined.withColumn("is_outlier", F.col("distance_to_center") > limit)


@dataclass(frozen=True)
class ClusterModel:
    """The fitted stages; it can be applied to new embeddings."""

    scaler: StandardScalerModel
    pca: PCAModel
    kmeans: KMeansModel

    def reduce(self, df: DataFrame) -> DataFrame:
        return first_two(self.pca.transform(self.scaler.transform(with_vector(df))))

    def apply(self, df: DataFrame, stds: float = 2.0) -> DataFrame:
        """Cluster, distance, cluster statistics and outlier flag of every row.

        The embeddings are transformed once: the statistics are taken from a written table
        of clusters and distances.
        """
        clustered = self.kmeans.transform(self.reduce(df))
        far = center_distance(clustered, center_table(self.kmeans, df), few=True)
        far, _ = stage(far, "clustered")
        return flag_outliers(far, stds, few=True)

    def save(self, path: str) -> None:
        for name in ("scaler", "pca", "kmeans"):
            getattr(self, name).save(f"{path}/{name}")

    @classmethod
    def load(cls, path: str) -> ClusterModel:
        return cls(
            StandardScalerModel.load(f"{path}/scaler"),
            PCAModel.load(f"{path}/pca"),
            KMeansModel.load(f"{path}/kmeans"),
        )


def fit_clusters(df: DataFrame, params: Params = Params()) -> ClusterModel:
    """Fit scaler, components and centers.

    The fits read the embeddings several times: pass a staged table, not a lazy encoder.
    Rows without an embedding are left out.
    """
    vectors = with_vector(df.where(F.col("embedding").isNotNull()))
    scaler = fit_scaler(vectors)
    scaled = scaler.transform(vectors)
    pca = fit_pca(scaled, params.pca_components)
    kmeans = fit_kmeans(first_two(pca.transform(scaled)), params.clusters, params.seed)
    return ClusterModel(scaler, pca, kmeans)


def process_and_cluster(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Embedded rows with cluster, distance, cluster statistics and outlier flag."""
    present = df.where(F.col("embedding").isNotNull())
    return fit_clusters(present, params).apply(present, params.outlier_stds)
