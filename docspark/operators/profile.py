"""Counts that describe a corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from docspark.functions.text import has_text


def _cells(df: DataFrame) -> DataFrame:
    """Filings per (year, company), the small table both profiles are made of."""
    return df.groupBy("year", "cik").agg(F.count(F.lit(1)).alias("n"))


def corpus_shape(df: DataFrame) -> DataFrame:
    """One row: filings, columns, distinct years and companies."""
    return _cells(df).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_filings"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.countDistinct("year").alias("n_years"),
        F.countDistinct("cik").alias("n_companies"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def corpus_values(df: DataFrame) -> DataFrame:
    """The distinct years and companies with their filings, one row each.

    Rows instead of one collected list: the number of companies has no bound.
    """
    cells = _cells(df)
    values = F.explode(
        F.array(
            F.struct(F.lit("year").alias("attribute"), F.col("year").cast("string").alias("value")),
            F.struct(F.lit("cik").alias("attribute"), F.col("cik").alias("value")),
        )
    )
    return (
        cells.select(values.alias("v"), "n")
        .groupBy("v.attribute", "v.value")
        .agg(F.sum("n").alias("n_filings"))
    )


def years_sorted(df: DataFrame) -> DataFrame:
    """The distinct years with their place in ascending order, from 1; null years are left out.

    The years are few by nature; they are made distinct per task before they are sorted.
    """
    years = df.select("year").where(F.col("year").isNotNull()).distinct()
    place = F.row_number().over(Window.orderBy("year"))
    return years.select(place.alias("place"), "year").orderBy("place")


def section_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("section_")]


def section_profile(df: DataFrame) -> DataFrame:
    """Per filing: its non-blank sections, their lengths, and a readable line.

    All sections of a filing sit in one row, so nothing is exploded or shuffled.
    """
    columns = section_columns(df)

    def total(values: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, values, F.lit(0))

    sizes = df.select(
        "filename",
        "year",
        "cik",
        *[F.when(has_text(F.col(c)), F.length(c)).alias(c) for c in columns],
    )
    return sizes.select(
        "filename",
        "year",
        "cik",
        total([F.col(c).isNotNull().cast("int") for c in columns]).alias("n_sections"),
        total([F.coalesce(F.col(c), F.lit(0)) for c in columns]).cast("long").alias("n_chars"),
        F.concat_ws(
            ", ",
            *[
                F.concat(F.lit(f"{c} ("), F.format_number(F.col(c), 0), F.lit(" chars)"))
                for c in columns
            ],
        ).alias("sections"),
    )


def embedding_shape(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    """One row: number of vectors and their dimension."""
    return df.agg(
        F.count(embedding).alias("n_vectors"),
        F.max(F.size(embedding)).alias("dim"),
    )
