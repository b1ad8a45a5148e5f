"""Scaling, reduction, clusters, outliers and plot tables: invariants and exact cases."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from docspark.operators import cluster, plots
from docspark.operators.embed import with_vector
from docspark.params import Params


def embedded(spark, matrix, parts=4):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id INT, embedding ARRAY<FLOAT>").repartition(parts)


def blobs(n=240, dim=6, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 6, (4, dim))
    return np.float32(centers[rng.integers(4, size=n)] + rng.normal(0, 1, (n, dim)))


def test_scaler_divides_by_sample_deviation_and_zeroes_constants(spark):
    matrix = blobs()
    matrix[:, 2] = 3
    df = with_vector(embedded(spark, matrix))
    scaled = cluster.fit_scaler(df).transform(df).orderBy("id")
    got = np.array([r.scaled_embedding.toArray() for r in scaled.collect()])
    std = matrix.astype(float).std(axis=0, ddof=1)
    expected = np.divide(matrix, std, out=np.zeros(matrix.shape), where=std > 1e-9)
    assert np.allclose(got, expected)


def test_components_are_capped_uncorrelated_and_ordered(spark):
    df = with_vector(embedded(spark, blobs()))
    model = cluster.fit_pca(df, 50, column="embedding_vector")
    got = np.array([r.pca_features_50.toArray() for r in model.transform(df).collect()])
    assert got.shape == (240, 6)
    cov = np.cov(got.T)
    assert np.allclose(cov - np.diag(np.diag(cov)), 0, atol=1e-8)
    assert (np.diff(np.diag(cov)) <= 1e-9).all()


def test_second_reduction_is_the_first_two_components(spark):
    df = with_vector(embedded(spark, blobs()))
    once = cluster.fit_pca(df, 5, column="embedding_vector").transform(df)
    twice = cluster.fit_pca(once, 2, column="pca_features_50", into="again").transform(once)
    rows = cluster.first_two(twice).select("again", "pca_features_2d").collect()
    a = np.array([r.again.toArray() for r in rows])
    b = np.array([r.pca_features_2d.toArray() for r in rows])
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-9)


def test_no_vectors_to_reduce(spark):
    with pytest.raises(ValueError):
        cluster.fit_pca(with_vector(embedded(spark, blobs(1)).limit(0)), column="embedding_vector")


def test_process_and_cluster(spark):
    matrix = blobs(300)
    df = embedded(spark, matrix).unionByName(
        spark.createDataFrame([(900, None)], "id INT, embedding ARRAY<FLOAT>")
    )
    params = Params(clusters=4)
    model = cluster.fit_clusters(df, params)
    rows = model.apply(df.where("embedding is not null")).collect()
    assert len(rows) == 300
    centers = np.array(model.kmeans.clusterCenters())
    for r in rows:
        point = r.pca_features_2d.toArray()
        far = np.linalg.norm(centers - point, axis=1)
        assert r.prediction == far.argmin()
        assert np.isclose(r.distance_to_center, far.min(), rtol=1e-5)
    by = {}
    for r in rows:
        by.setdefault(r.prediction, []).append(r)
    for members in by.values():
        d = np.array([m.distance_to_center for m in members])
        assert np.isclose(members[0].mean_dist, d.mean())
        assert np.isclose(members[0].std_dist, d.std(ddof=1))
        limit = members[0].mean_dist + 2 * members[0].std_dist
        assert all(m.is_outlier == (m.distance_to_center > limit) for m in members)
    assert cluster.process_and_cluster(df, params).columns == [
        "prediction", "id", "embedding", "embedding_vector", "scaled_embedding",
        "pca_features_50", "pca_features_2d", "distance_to_center", "mean_dist", "std_dist",
        "is_outlier",
    ]


def test_clusters_do_not_depend_on_the_input_layout(spark, monkeypatch):
    monkeypatch.setattr(cluster, "FIT_PARTITIONS", 6)
    matrix = blobs(300, seed=2)
    found = []
    for parts in (1, 3, 8):
        model = cluster.fit_clusters(embedded(spark, matrix, parts), Params(clusters=7))
        found.append(np.array(model.kmeans.clusterCenters()))
    # The sign of a component is free, the layout of the centers is not.
    assert np.allclose(np.abs(found[0]), np.abs(found[1]))
    assert np.allclose(np.abs(found[0]), np.abs(found[2]))


def test_copies_weigh_like_single_rows(spark):
    """Many copies become one weighted point; the center is still the mean of all rows."""
    matrix = np.vstack([np.tile([[5.0, 5.0]], (90, 1)), [[0, 0], [0, 1], [6, 5]]])
    df = embedded(spark, matrix).withColumn("pca_features_2d", array_to_vector("embedding"))
    model = cluster.fit_kmeans(df, k=2)
    centers = sorted(tuple(c) for c in model.clusterCenters())
    assert np.allclose(centers, [(0, 0.5), ((90 * 5 + 6) / 91, 5)])


def distances(spark):
    rows = [(0, 1.0)] * 20 + [(0, 9.0), (1, 2.0)]
    return spark.createDataFrame(rows, "prediction INT, distance_to_center FLOAT")


@pytest.mark.parametrize("few", [False, True])
def test_flags_and_the_cluster_of_one(spark, few):
    rows = cluster.flag_outliers(distances(spark), few=few).collect()
    assert [r.is_outlier for r in rows if r.prediction == 1] == [None]
    assert [r.distance_to_center for r in rows if r.is_outlier] == [9.0]
    strict = cluster.flag_outliers(distances(spark), stds=100.0).where("is_outlier").count()
    assert strict == 0


def test_only_known_cluster_counts_are_broadcast(spark):
    known = cluster.flag_outliers(distances(spark), few=True)
    unknown = cluster.flag_outliers(distances(spark))
    assert "strategy=broadcast" in known._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in unknown._jdf.queryExecution().analyzed().toString()


def test_mean_centers_and_distance(spark):
    df = spark.createDataFrame(
        [(0, [0.0, 0.0]), (0, [2.0, 0.0]), (1, [5.0, 5.0])], "prediction INT, embedding ARRAY<FLOAT>"
    )
    centers = cluster.mean_centers(df)
    assert sorted((r.prediction, r.center) for r in centers.collect()) == [
        (0, [1.0, 0.0]), (1, [5.0, 5.0])
    ]
    far = cluster.center_distance(df, centers, "embedding")
    assert sorted(r.distance_to_center for r in far.collect()) == [0.0, 1.0, 1.0]


def test_saved_models_give_the_same_clusters(spark, tmp_path):
    df = embedded(spark, blobs())
    model = cluster.fit_clusters(df, Params(clusters=3))
    model.save(str(tmp_path / "model"))
    again = cluster.ClusterModel.load(str(tmp_path / "model"))
    one = {r.id: r.prediction for r in model.apply(df).collect()}
    assert one == {r.id: r.prediction for r in again.apply(df).collect()}


@pytest.fixture(scope="module")
def points(spark):
    rows = [
        ([0.1, 0.2], 0, None, "ITEM 1", "A"),
        ([0.2, 0.4], 0, True, "ITEM 1", "A"),
        ([-0.1, 0.2], 1, False, "ITEM 7", "B"),
    ]
    df = spark.createDataFrame(
        rows,
        "p ARRAY<DOUBLE>, prediction INT, is_outlier BOOLEAN, section_title STRING, company_name STRING",
    )
    return plots.plot_points(df.withColumn("pca_features_2d", array_to_vector("p")))


def test_plot_points(points):
    assert points.columns == ["x", "y", "cluster", "outlier", "section", "company"]
    assert sorted(r.outlier for r in points.collect()) == [False, False, True]


def test_plot_bins(points):
    def cells(df):
        return sorted(tuple(r) for r in df.collect())

    assert cells(plots.by_cluster(points)) == [(-0.5, 0.0, 1, 1), (0.0, 0.0, 0, 2)]
    assert cells(plots.by_outlier(points)) == [
        (-0.5, 0.0, False, 1), (0.0, 0.0, False, 1), (0.0, 0.0, True, 1)
    ]
    assert cells(plots.by_section(points)) == [(-0.5, 0.0, "ITEM 7", 1), (0.0, 0.0, "ITEM 1", 2)]
    assert cells(plots.by_company(points)) == [(-0.5, 0.0, "B", 1, 1), (0.0, 0.0, "A", 0, 2)]


def test_sample_points(points):
    assert plots.sample_points(points, {0: 1.0}).count() == 2


def test_plane_is_pruned_to_two_numbers(points):
    assert points.select("x").schema["x"].dataType.typeName() == "double"
    assert points.agg(F.max("y")).first()[0] == 0.4


def test_sample_by_hash_depends_on_rows_only(spark):
    rows = spark.range(2000).selectExpr("id", "cast(id % 4 as int) as prediction")
    rows = rows.unionByName(spark.createDataFrame([(None, 0)], "id long, prediction int"))
    fractions = {0: 1.0, 1: 0.3, 2: 0.0}
    found = [sorted(r.id for r in plots.sample_by_hash(rows.repartition(n), fractions, "id").collect()) for n in (1, 7)]
    assert found[0] == found[1]
    groups = [sum(i % 4 == g for i in found[0]) for g in range(4)]
    assert groups[0] == 500 and 110 < groups[1] < 190 and groups[2:] == [0, 0]
    other = [r.id for r in plots.sample_by_hash(rows, fractions, "id", seed=2).collect()]
    assert sorted(other) != found[0]
