"""Wide filings → chunks → embeddings → answers, checked against known ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from docspark.operators.chunk import chunk_wide
from docspark.operators.embed import Encoder, embed
from docspark.operators.evaluate import evaluate_retrieval, summarise, validation_items
from docspark.operators.search import search_one
from docspark.params import Params
from docspark.sources import staging


@dataclass(frozen=True)
class Retrieval:
    """The searchable chunks, the checked items and their summary."""

    chunks: DataFrame
    n_chunks: int
    items: DataFrame
    checked: DataFrame
    summary: DataFrame


def index_chunks(filings: DataFrame, encoder: Encoder, params: Params = Params()) -> DataFrame:
    """Embedded chunks of the searched sections, not yet written."""
    chunks = chunk_wide(
        filings, params.sections, size=params.chunk_words, overlap=params.overlap_words
    )
    return embed(chunks, encoder, "text")


def retrieve(
    filings: DataFrame,
    items: DataFrame,
    encoder: Encoder,
    params: Params = Params(),
    year: int | None = None,
) -> Retrieval:
    """Build the chunk table, then check the search on the validation items.

    The returned chunks are a written table: pass them to :func:`ask` for more questions.
    """
    chunks, n_chunks = staging.stage(index_chunks(filings, encoder, params), "chunks")
    # The search and the check both read the kept items.
    kept, _ = staging.stage(validation_items(filings, items, year), "items")
    checked = evaluate_retrieval(chunks, kept, encoder, params.eval_top_k)
    return Retrieval(chunks, n_chunks, kept, checked, summarise(checked))


def ask(
    chunks: DataFrame, question: str, year: int, encoder: Encoder, params: Params = Params()
) -> DataFrame:
    """Answer one more question from the chunk table."""
    return search_one(
        chunks, question, year, encoder, params.top_k, preview_chars=params.preview_chars
    )
