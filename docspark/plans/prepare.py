"""Filter wide filings, profile them, and write them out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from docspark.operators import profile
from docspark.sources import filings as src


@dataclass(frozen=True)
class Prepared:
    filings: DataFrame
    shape: DataFrame
    values: DataFrame
    sections: DataFrame


def prepare(
    filings: DataFrame,
    *,
    cik: str | int | None = None,
    years: list[int] | None = None,
    csv: str | None = None,
    table: str | None = None,
) -> Prepared:
    """Keep a company and some years; write the result where a path is given."""
    kept = src.filter_cik_years(filings, cik, years)
    if csv is not None:
        src.write_csv(kept, csv)
    if table is not None:
        src.write_table(kept, table, partition_by="year")
    return Prepared(
        kept, profile.corpus_shape(kept), profile.corpus_values(kept), profile.section_profile(kept)
    )
