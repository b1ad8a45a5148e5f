"""Raw filings → sections → chunks → embeddings → clusters → plot tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from docspark.operators import plots
from docspark.operators.chunk import chunk_raw
from docspark.operators.cluster import process_and_cluster
from docspark.operators.embed import Encoder, embed
from docspark.operators.select import select_companies
from docspark.params import Params
from docspark.sources import staging

@dataclass(frozen=True)
class Exploration:
    """The clustered chunks, the plot tables and the rows of every stage."""

    clustered: DataFrame
    plots: dict[str, DataFrame]
    rows: dict[str, int]


def explore(
    filings: DataFrame,
    encoder: Encoder,
    params: Params = Params(),
    ciks: list[str] | None = None,
) -> Exploration:
    """Run the whole exploration.

    Two stages are written: the embeddings, because the fits read them several times, and
    the narrow plot points, because all plots read them.  All counts come from these
    writes.  The clustered rows with their vectors stay a plan over the embeddings: they
    are several times as large as the texts and cheap to compute again.
    """
    chosen, n_filings = staging.observed(
        select_companies(filings, params.n_companies, ciks), "filings"
    )
    chunks, n_chunks = staging.observed(
        chunk_raw(chosen, size=params.chunk_words, overlap=params.overlap_words), "chunks"
    )
    embedded, n_embedded = staging.stage(embed(chunks, encoder), "embedded")
    clustered = process_and_cluster(embedded, params)
    points, n_clustered = staging.stage(plots.plot_points(clustered), "points")
    return Exploration(
        clustered=clustered,
        plots={
            "points": points,
            "clusters": plots.by_cluster(points, params.bin_width),
            "outliers": plots.by_outlier(points, params.bin_width),
            "sections": plots.by_section(points, params.bin_width),
            "combined": plots.by_company(points, params.bin_width),
        },
        rows={
            "filings": n_filings.get["rows"],
            "chunks": n_chunks.get["rows"],
            "embedded": n_embedded,
            "clustered": n_clustered,
        },
    )


def write_plots(result: Exploration, folder: str) -> None:
    """One table per figure."""
    for name, table in result.plots.items():
        table.write.parquet(f"{folder}/{name}")


