"""Checking the search against known answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docspark import schemas
from docspark.operators.embed import Encoder
from docspark.operators.profile import section_columns
from docspark.operators.search import search
from docspark.operators.select import first_per_year


def validation_items(filings: DataFrame, items: DataFrame, year: int | None = None) -> DataFrame:
    """The items whose expected section is present in the first filing of their year.

    ``items`` have ``item_id, query, expected_section, expected_answer`` and ``year``;
    a given ``year`` replaces that column.  The company comes from the filing.
    """
    if year is not None:
        items = items.withColumn("year", F.lit(year).cast("int"))
        filings = filings.where(F.col("year") == year)
    sections = section_columns(filings)
    flags = filings.select(
        "filename", "year", "cik", *[F.col(c).isNotNull().alias(c) for c in sections]
    )
    present = (
        first_per_year(flags)
        .unpivot(["year", "cik"], sections, "expected_section", "present")
        .where("present")
        .drop("present")
    )
    return items.join(present, ["year", "expected_section"]).select(*schemas.VALIDATION_ITEM.names)


def check_hits(items: DataFrame, hits: DataFrame) -> DataFrame:
    """Per item: whether the first hit holds the answer, the rank of the first hit that
    does, and the number of hits."""
    found = F.contains(F.lower("full_text"), F.lower("expected_answer"))
    answers = items.withColumnRenamed("item_id", "query_id").drop("query", "year", "cik")
    ranked = answers.join(hits, "query_id", "left")
    hit_rank = F.min(F.when(found, F.col("rank")))
    return (
        ranked.groupBy("query_id")
        .agg(hit_rank.alias("hit_rank"), F.count("rank").alias("n_hits"))
        .select(
            F.col("query_id").alias("item_id"),
            F.coalesce(F.col("hit_rank") == 1, F.lit(False)).alias("hit_at_1"),
            "hit_rank",
            "n_hits",
        )
    )


def evaluate_retrieval(
    chunks: DataFrame, items: DataFrame, encoder: Encoder, k: int = 3
) -> DataFrame:
    """Search for every item and check the hits."""
    queries = items.select(F.col("item_id").alias("query_id"), "query", "year")
    return check_hits(items, search(chunks, queries, encoder, k))


def summarise(checked: DataFrame) -> DataFrame:
    """One row: items, items answered by the first hit, by any hit, and without hits."""
    return checked.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if("hit_at_1").alias("n_hit_at_1"),
        F.count("hit_rank").alias("n_hit_in_k"),
        F.count_if(F.col("n_hits") == 0).alias("n_without_hits"),
        F.avg(F.col("hit_at_1").cast("double")).alias("hit_rate_at_1"),
        F.avg(F.col("hit_rank").isNotNull().cast("double")).alias("hit_rate_in_k"),
    )


