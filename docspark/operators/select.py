"""Choosing companies, rows and first filings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docspark.sources.staging import stage


def first_companies(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` distinct companies in ``cik`` order."""
    return df.where(F.col("cik").isNotNull()).select("cik").distinct().orderBy("cik").limit(n)


def keep_companies(df: DataFrame, companies: DataFrame) -> DataFrame:
    """Filings of the given companies.

    The list may be long: the adaptive planner sees its real size and splits hot companies.
    """
    return df.join(companies.select("cik"), "cik", "left_semi")


def select_companies(df: DataFrame, n: int = 5, ciks: list[str] | None = None) -> DataFrame:
    """Filings of a fixed list of companies, or of the first ``n``, a small number."""
    if ciks is not None:
        return df.where(F.col("cik").isin([str(c) for c in ciks]))
    return keep_companies(df, F.broadcast(first_companies(df, n)))


def in_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("year") == year)


def first_per_year(df: DataFrame, order_by: str = "filename") -> DataFrame:
    """One filing per year, the first by name; an empty year gives no row.

    Filings without a name come last, equal names go by the other columns.  The first name of
    each year is found on two narrow columns and written, a row per year, so the planner knows
    the size of what it joins; only filings of that name are compared as a whole.
    """
    rest = [c for c in df.columns if c not in ("year", order_by)]
    dated = df.where(F.col("year").isNotNull())
    name = F.struct(F.col(order_by).isNull().alias("unnamed"), F.col(order_by).alias("name"))
    names = dated.groupBy("year").agg(F.min(name).alias("_first")).select("year", F.col("_first.name").alias("_first"))
    names, _ = stage(names, "first_names")
    named = dated.join(names, (dated["year"] == names["year"]) & dated[order_by].eqNullSafe(names["_first"]), "left_semi")
    first = named.groupBy("year", order_by).agg(F.min(F.struct(*rest)).alias("row") if rest else F.count("*").alias("row"))
    return first.select(*[F.col("row")[c].alias(c) if c in rest else F.col(c) for c in df.columns])
