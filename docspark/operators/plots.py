"""Tables behind the scatter plots.

A plot of billions of points is a picture of their density, so every figure is a table of
grid bins with counts; its size follows the grid, not the data.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def plot_points(df: DataFrame, section: str = "section_title") -> DataFrame:
    """``x, y, cluster, outlier, section, company`` of every clustered row."""
    point = vector_to_array("pca_features_2d")
    return df.select(
        point[0].alias("x"),
        point[1].alias("y"),
        F.col("prediction").alias("cluster"),
        F.coalesce("is_outlier", F.lit(False)).alias("outlier"),
        F.col(section).alias("section"),
        F.col("company_name").alias("company"),
    )


def sample_points(points: DataFrame, fractions: dict[int, float], seed: int = 1) -> DataFrame:
    """A stratified sample by cluster, for callers that draw single points."""
    return points.sampleBy("cluster", fractions, seed)


def sample_by_hash(
    df: DataFrame, fractions: dict[int, float], key: str, *, by: str = "prediction", seed: int = 1
) -> DataFrame:
    """A stratified sample that depends on the rows only, not on how they are laid out.

    A row stays if the hash of ``seed`` and ``key``, as a share of all hashes, is below the fraction
    of its group; groups without a fraction go, as do rows without a key.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32
    limit = F.lit(0.0)
    for group, fraction in fractions.items():
        limit = F.when(F.col(by) == group, F.lit(float(fraction))).otherwise(limit)
    return df.where(share < limit)


def bins(points: DataFrame, by: list[str], width: float) -> DataFrame:
    """Number of points per grid cell and group; ``x`` and ``y`` are the cell's corner."""
    return points.groupBy(
        (F.floor(F.col("x") / width) * width).alias("x"),
        (F.floor(F.col("y") / width) * width).alias("y"),
        *by,
    ).agg(F.count(F.lit(1)).alias("n_points"))


def by_cluster(points: DataFrame, width: float = 0.5) -> DataFrame:
    return bins(points, ["cluster"], width)


def by_outlier(points: DataFrame, width: float = 0.5) -> DataFrame:
    return bins(points, ["outlier"], width)


def by_section(points: DataFrame, width: float = 0.5) -> DataFrame:
    return bins(points, ["section"], width)


def by_company(points: DataFrame, width: float = 0.5) -> DataFrame:
    """Company and cluster together."""
    return bins(points, ["company", "cluster"], width)
