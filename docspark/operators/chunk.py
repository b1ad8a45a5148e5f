"""Fixed-size word chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docspark.functions import text as tx
from docspark.operators.sections import extract_sections
from docspark.params import SEARCH_SECTIONS


def chunk_words(
    df: DataFrame,
    text: str = "text",
    *,
    into: str = "chunk_text",
    size: int = 500,
    overlap: int = 0,
) -> DataFrame:
    """Replace ``text`` by its chunks, one row each, numbered from 0 in ``chunk_index``.

    The collapsed text is a column of its own, because a generator, unlike a projection,
    would evaluate its repeated parts again.
    """
    others = [c for c in df.columns if c != text]
    plain = df.select(*others, tx.collapse(F.col(text)).alias("_plain"))
    windows = tx.word_windows(F.col("_plain"), size, overlap)
    return plain.select(*others, F.posexplode(windows).alias("chunk_index", into))


def chunk_raw(
    df: DataFrame,
    *,
    size: int = 500,
    overlap: int = 0,
    keep_last: bool = False,
    inline_titles: bool = False,
) -> DataFrame:
    """Filings with one text column → sections → chunks."""
    filings = df.select("cik", "company_name", "filing_type", "year", "text")
    sections = extract_sections(filings, keep_last=keep_last, inline_titles=inline_titles)
    chunks = chunk_words(sections, "section_text", size=size, overlap=overlap)
    return chunks.select(
        "cik", "company_name", "filing_type", "year", "section_title", "chunk_text", "chunk_index"
    )


def chunk_wide(
    df: DataFrame,
    sections: tuple[str, ...] = SEARCH_SECTIONS,
    *,
    size: int = 500,
    overlap: int = 0,
) -> DataFrame:
    """Filings with one column per section → chunks of the chosen sections."""
    cells = [(F.lit(s), F.lit(i), F.col(s)) for i, s in enumerate(sections)]
    long = df.select(
        "filename",
        "cik",
        "year",
        F.stack(F.lit(len(cells)), *[c for cell in cells for c in cell]).alias(
            "section", "section_pos", "text"
        ),
    ).where(F.col("text").isNotNull())
    chunks = chunk_words(long, into="text", size=size, overlap=overlap)
    return chunks.select(
        "text",
        "year",
        "cik",
        "filename",
        "section",
        "section_pos",
        "chunk_index",
        F.concat_ws("_", "filename", "section", F.col("chunk_index").cast("string")).alias("chunk_id"),
    )


def chunk_metadata(chunks: DataFrame, text: str = "text") -> DataFrame:
    """Everything but the text."""
    return chunks.drop(text)
