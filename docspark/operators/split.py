"""Chunks that follow the text: whole sentences, paragraphs first, or changes of topic.

Sentences are found, counted and joined by expressions within the row, each in one walk over the
text; only the embedding of sentences runs in Python, on Arrow batches.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docspark.functions import text as tx
from docspark.operators.embed import Encoder

# Distances of neighbours are compared at this precision.
DISTANCE_DIGITS = 9
# Sentences whose vectors a task holds at a time; more if a single text has more.
HELD_SENTENCES = 8_192
# A blank line.
PARAGRAPH = rf"\n(?:{tx.WS})*\n"


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """A value that an expression uses often, computed once per row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def word_count(plain: Column) -> Column:
    """Words of a collapsed text that is not empty."""
    return F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1


def _pieces(plain: Column, size: int) -> Column:
    """Sentences; one of more than ``size`` words in windows of so many."""
    whole = lambda s: F.when(word_count(s) > size, tx.word_windows(s, size)).otherwise(F.array(s))
    return F.flatten(F.transform(tx.sentences(plain), whole))


def _fill(sizes: Column, size: int) -> Column:
    """Where groups of neighbours start, from 1: each takes what fits in ``size`` words."""
    start = F.struct(
        F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("held"), F.lit(0).alias("nth")
    )

    def add(group: Column, words: Column) -> Column:
        new = (group["nth"] == 0) | (group["held"] + words > size)
        return F.struct(
            # The list is copied when a group starts, not with every piece.
            F.when(new, F.concat(group["cuts"], F.array(group["nth"] + 1))).otherwise(group["cuts"]).alias("cuts"),
            F.when(new, words).otherwise(group["held"] + words).alias("held"),
            (group["nth"] + 1).alias("nth"),
        )

    return F.aggregate(sizes, start, add, lambda group: group["cuts"])


def _joined(pieces: Column, cuts: Column) -> Column:
    """The groups' texts."""
    end = lambda nth: F.coalesce(F.get(cuts, nth + 1), F.size(pieces) + 1)
    return F.transform(cuts, lambda at, nth: F.array_join(F.slice(pieces, at, end(nth) - at), " "))


def _filled(pieces: Column, size: int) -> Column:
    def of(own: Column) -> Column:
        return bound(_fill(F.transform(own, word_count), size), lambda cuts: _joined(own, cuts))

    return bound(pieces, of)


def _plain(df: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    others = [c for c in df.columns if c != text]
    return df.select(*others, tx.collapse(F.col(text)).alias("_plain")), others


def chunk_sentences(df: DataFrame, text: str = "text", *, into: str = "chunk_text", size: int = 500) -> DataFrame:
    """Replace ``text`` by chunks of whole sentences, numbered from 0 in ``chunk_index``.

    A chunk takes sentences as long as they fit in ``size`` words.  A sentence of more words
    is cut in windows of ``size`` words, and the last one may take further sentences.  Joined by
    blanks, the chunks of a text are the text with its white space collapsed.
    """
    if size < 1:
        raise ValueError("need size >= 1")
    plain, others = _plain(df, text)
    found = F.when(F.length("_plain") > 0, _filled(_pieces(F.col("_plain"), size), size))
    # A column of its own: a generator would evaluate its parts again.
    made = plain.select(*others, found.alias("_chunks"))
    return made.select(*others, F.posexplode_outer("_chunks").alias("chunk_index", into)).where("chunk_index IS NOT NULL")


def chunk_recursive(
    df: DataFrame,
    text: str = "text",
    *,
    into: str = "chunk_text",
    size: int = 500,
    overlap: int = 0,
    paragraph: str = PARAGRAPH,
) -> DataFrame:
    """Replace ``text`` by chunks of paragraphs, or of sentences or words where those are too long.

    Only a paragraph of more than ``size`` - ``overlap`` words is cut into sentences, and only
    such a sentence into windows of words.  Neighbouring pieces are then merged as long as they
    fit.  From the second chunk on, the last ``overlap`` words of what stands before are put in
    front, so no chunk has more than ``size`` words.  Without them, the chunks of a
    text joined by blanks are the text with its white space collapsed.
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("need size >= 1 and 0 <= overlap < size")
    own = size - overlap
    others = [c for c in df.columns if c != text]
    paragraphs = F.transform(F.split(F.col(text), paragraph, -1), tx.collapse)
    paragraphs = F.filter(paragraphs, lambda p: F.length(p) > 0)
    cut = lambda p: F.when(word_count(p) > own, _pieces(p, own)).otherwise(F.array(p))
    split = df.select(*others, paragraphs.alias("_paragraphs"))
    made = split.select(*others, _filled(F.flatten(F.transform("_paragraphs", cut)), own).alias("_chunks"))
    if overlap:
        tail = lambda p: F.regexp_extract(p, rf"(?:^|(?<= ))[^ ]+(?: [^ ]+){{0,{overlap - 1}}}$", 0)
        ends = lambda chunks, nth: tail(F.get(chunks, nth - 1))
        lapped = F.transform(
            "_chunks",
            lambda c, nth: F.when(nth > 0, F.concat(ends(F.col("_chunks"), nth), F.lit(" "), c)).otherwise(c),
        )
        made = made.select(*others, lapped.alias("_chunks"))
    return made.select(*others, F.posexplode_outer("_chunks").alias("chunk_index", into)).where("chunk_index IS NOT NULL")


def _topic_cuts(encoder: Encoder, percentile: float):
    """Where topics start among a text's sentences, from 1, given all sentences of a batch."""
    load, size, held = encoder.load, encoder.batch_size, HELD_SENTENCES

    @F.arrow_udf("array<int>")
    def cuts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()

        def unit(texts: list[str]) -> np.ndarray:
            parts = [np.asarray(model(texts[i : i + size]), np.float64) for i in range(0, len(texts), size)]
            vectors = np.concatenate(parts) if parts else np.zeros((0, 1))
            length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)

        for batch in batches:
            sentences = batch.flatten()
            ends = np.cumsum(pc.list_value_length(batch).fill_null(0).to_numpy(zero_copy_only=False))
            found, row = [], 0
            while row < len(batch):
                # Some texts at a time, so that few vectors are held.
                start = int(ends[row - 1]) if row else 0
                last = max(row + 1, int(np.searchsorted(ends, start + held, "right")))
                vectors = unit(sentences[start : int(ends[last - 1])].to_pylist())
                for a, b in zip([start, *ends[row : last - 1].tolist()], ends[row:last].tolist()):
                    own = vectors[a - start : b - start]
                    apart = np.round(1 - (own[1:] * own[:-1]).sum(axis=1), DISTANCE_DIGITS)
                    limit = np.round(np.quantile(apart, percentile), DISTANCE_DIGITS) if len(apart) else 0.0
                    found.append([1, *(np.flatnonzero(apart > limit) + 2).tolist()] if b > a else [])
                row = last
            yield pa.array(found, pa.list_(pa.int32()))

    return cuts


def chunk_semantic(
    df: DataFrame,
    encoder: Encoder,
    text: str = "text",
    *,
    into: str = "chunk_text",
    percentile: float = 0.9,
    size: int = 500,
) -> DataFrame:
    """Replace ``text`` by chunks that end where the topic changes.

    Neighbouring sentences are compared by the cosine of their embeddings; a chunk ends where their
    distance is above the given percentile of all distances in the text.  A chunk of
    more than ``size`` words is cut further, at sentences.  Joined by blanks, the chunks of a
    text are the text with its white space collapsed.
    """
    if size < 1 or not 0 <= percentile <= 1:
        raise ValueError("need size >= 1 and 0 <= percentile <= 1")
    plain, others = _plain(df, text)
    found = F.when(F.length("_plain") > 0, _pieces(F.col("_plain"), size))
    cut = plain.select(*others, F.coalesce(found, F.array().cast("array<string>")).alias("_pieces"))
    # Topics and the pieces in each, then each topic filled up to the size.
    cut = cut.select(*others, "_pieces", _topic_cuts(encoder, percentile)("_pieces").alias("_cuts"))
    end = lambda nth: F.coalesce(F.get("_cuts", nth + 1), F.size("_pieces") + 1)
    topics = F.transform("_cuts", lambda at, nth: F.slice("_pieces", at, end(nth) - at))
    made = cut.select(*others, topics.alias("_topics"))
    made = made.select(*others, F.flatten(F.transform("_topics", lambda t: _filled(t, size))).alias("_chunks"))
    return made.select(*others, F.posexplode_outer("_chunks").alias("chunk_index", into)).where("chunk_index IS NOT NULL")
