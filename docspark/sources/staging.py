"""Materialised stages in the shared folder, counted while they are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; only a local session may make its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="docspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/docspark/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{name}"


def release(spark: SparkSession) -> None:
    """Remove every stage that this application wrote; tables read from them are gone then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side product of whatever action runs next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage(df: DataFrame, name: str, path: str | None = None) -> tuple[DataFrame, int]:
    """Write a stage once, to a folder of its own or to ``path``, and return the table read back with its row count.

    A written table outlives lost executors, and later passes read only the columns they
    use, unlike a row checkpoint.
    """
    path = path if path is not None else new_folder(df.sparkSession, name)
    counted, seen = observed(df, name)
    counted.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]
