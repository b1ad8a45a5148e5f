"""Sections of a filing's raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docspark.functions import text as tx

# A substring of this length reaches the end of any text.
_REST = 2**31 - 1


def _last_of_each_title(ordered: Column) -> Column:
    """Of sections sorted by title and position keep those whose title is new next."""
    following = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered), F.lit(1)))
    marked = F.zip_with(
        ordered,
        following,
        lambda a, b: F.struct(
            a.alias("section"),
            (b.isNull() | (a["title"] != b["title"])).alias("keep"),
        ),
    )
    return F.transform(F.filter(marked, lambda m: m["keep"]), lambda m: m["section"])


def extract_sections(
    df: DataFrame,
    text: str = "text",
    *,
    keep_last: bool = False,
    inline_titles: bool = False,
) -> DataFrame:
    """One row per section: ``section_pos``, ``section_title``, ``section_text``.

    A header stands alone on its line; a section runs to the next header, so by default
    the text after the last header is no section (``keep_last`` keeps it).
    ``inline_titles`` also accepts a title behind the header.  Of equal titles in one
    filing the last counts.  Filings without headers and null texts give no rows.

    Row-local: one regex split of the text, no shuffle.
    """
    others = [c for c in df.columns if c != text]
    pieces = F.col("_pieces")
    if not keep_last:
        pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    headed = F.transform(
        pieces,
        lambda p: F.struct(
            tx.header_of(p, inline_titles=inline_titles).alias("header"), p.alias("piece")
        ),
    )
    sections = F.transform(
        F.filter(headed, lambda h: h["header"] != ""),
        lambda h, i: F.struct(
            tx.section_title(h["header"]).alias("title"),
            i.alias("pos"),
            F.substring(h["piece"], F.length(h["header"]) + 1, F.lit(_REST)).alias("body"),
        ),
    )
    body = F.col("_s.body")
    if inline_titles:
        body = F.regexp_replace(body, r"\A[^\n]*", "")
    return (
        df.withColumn("_pieces", tx.header_pieces(F.col(text), inline_titles=inline_titles))
        .select(*others, F.array_sort(sections).alias("_sections"))
        .select(*others, F.explode(_last_of_each_title(F.col("_sections"))).alias("_s"))
        .select(
            *others,
            F.col("_s.pos").alias("section_pos"),
            F.col("_s.title").alias("section_title"),
            tx.strip(body).alias("section_text"),
        )
    )
