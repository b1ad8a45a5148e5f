"""Every tunable constant in one immutable place."""

from __future__ import annotations

from dataclasses import dataclass

# Texts that stand for "missing" in a delimited file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The sections that are searched, in search order.
SEARCH_SECTIONS = ("section_1", "section_1A", "section_7", "section_8", "section_10")


@dataclass(frozen=True)
class Params:
    """Settings shared by the operators; pass a changed copy to a plan."""

    n_companies: int = 5
    chunk_words: int = 500
    overlap_words: int = 0
    sections: tuple[str, ...] = SEARCH_SECTIONS
    pca_components: int = 50
    clusters: int = 7
    seed: int = 1
    outlier_stds: float = 2.0
    top_k: int = 5
    eval_top_k: int = 3
    preview_chars: int = 200
    bin_width: float = 0.5
