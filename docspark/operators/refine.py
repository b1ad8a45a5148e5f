"""Searches in more than one step: questions in several wordings, and a second look at the hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docspark import schemas
from docspark.functions import text as tx
from docspark.operators.embed import Encoder
from docspark.operators.search import CHUNK_ORDER, SCORE_DIGITS, embed_queries, top_k
from docspark.sources.staging import stage


def variants(queries: DataFrame, synonyms: DataFrame) -> DataFrame:
    """The wordings of every question: as asked, and with one word exchanged for a synonym.

    ``synonyms`` has word, synonym and weight, the words in lower case.  A wording weighs as
    much as its synonym, the question itself 1.  Adds ``variant`` (0 for the question itself, then
    the place of the exchanged word) and ``weight``; the text is collapsed.  Equal wordings of a
    question count once, with their largest weight; a pair without a word, a synonym or a
    weight is passed over.
    """
    others = [c for c in queries.columns if c != "query"]
    plain = queries.withColumn("query", tx.collapse(F.col("query")))
    words = plain.select(*others, F.split("query", " ").alias("_words"))
    each = words.select(*others, "_words", F.posexplode("_words").alias("_at", "_word"))
    pairs = synonyms.select(F.col("word").alias("_known"), F.col("synonym").alias("_new"), F.col("weight").alias("weight"))
    pairs = pairs.where("_new IS NOT NULL AND weight IS NOT NULL")
    found = each.join(pairs, F.lower("_word") == F.col("_known"))
    changed = F.transform("_words", lambda w, i: F.when(i == F.col("_at"), F.col("_new")).otherwise(w))
    exchanged = found.select(*others, F.array_join(changed, " ").alias("query"), (F.col("_at") + 1).alias("variant"), F.col("weight").cast("double").alias("weight"))
    every = plain.select(*others, "query", F.lit(0).alias("variant"), F.lit(1.0).alias("weight")).unionByName(exchanged)
    best = F.max(F.struct("weight", (-F.col("variant")).alias("_back"))).alias("_best")
    once = every.groupBy(*others, "query").agg(best)
    return once.select(*others, "query", (-F.col("_best._back")).alias("variant"), F.col("_best.weight").alias("weight"))


def search_expanded(
    chunks: DataFrame,
    queries: DataFrame,
    synonyms: DataFrame,
    encoder: Encoder,
    k: int = 5,
    *,
    preview_chars: int = 200,
) -> DataFrame:
    """Answer questions in all their wordings; a chunk's score is the best of weight times cosine.

    The ``k`` best of every wording are enough: a chunk behind ``k`` others in the wording that suits
    it best is behind them in the result too.  So ``k`` different chunks come back.
    """
    name = F.concat_ws("_", F.col("query_id").cast("string"), "variant", F.xxhash64("query"))
    worded, _ = stage(variants(queries, synonyms).withColumn("_wording", name), "wordings")
    asked = embed_queries(worded.select(F.col("_wording").alias("query_id"), "query", "year"), encoder)
    hits = top_k(chunks, asked, k).withColumnRenamed("query_id", "_wording").drop("rank")
    hits = hits.join(worded.select("_wording", "query_id", "weight"), "_wording")
    score = F.round(F.col("similarity_score") * F.col("weight"), SCORE_DIGITS)
    carried = [c for c in hits.columns if c not in ("_wording", "weight", "similarity_score")]
    best = hits.withColumn("similarity_score", score).groupBy(*carried).agg(F.max("similarity_score").alias("similarity_score"))
    order = [F.desc("similarity_score"), *[F.col(c).asc_nulls_last() for c in CHUNK_ORDER]]
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= k).withColumn("chunk", tx.preview(F.col("text"), preview_chars))
    return ranked.withColumnRenamed("text", "full_text").select(*schemas.SEARCH_HIT.names)


@dataclass(frozen=True)
class Scorer:
    """How to score pairs of a question and a text.

    ``load`` runs once per task and returns a function from a list of pairs to as many numbers;
    ``batch_size`` is the number of pairs per call.
    """

    load: Callable[[], Callable[[list[tuple[str, str]]], np.ndarray]]
    batch_size: int = 32


def word_overlap() -> Scorer:
    """The share of a question's different words that a text has; needs no model."""

    def load() -> Callable[[list[tuple[str, str]]], np.ndarray]:
        def score(pairs: list[tuple[str, str]]) -> np.ndarray:
            asked = [(set(q.lower().split()), set(t.lower().split())) for q, t in pairs]
            return np.array([len(q & t) / len(q) if q else 0.0 for q, t in asked])

        return score

    return Scorer(load, batch_size=1024)


def rerank(hits: DataFrame, scorer: Scorer, k: int = 5) -> DataFrame:
    """Score hits (query_id, rank, query, full_text, …) anew and keep the ``k`` best of each question.

    ``similarity_score`` becomes the new score, rounded to nine digits.  Equal scores keep the order of
    the first search; hits that get no number come last, hits without a text are scored as
    empty ones.
    """
    load, size = scorer.load, scorer.batch_size

    @F.arrow_udf("double")
    def scores(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = load()
        for questions, texts in batches:
            pairs = [(q or "", t or "") for q, t in zip(questions.to_pylist(), texts.to_pylist())]
            parts = [np.asarray(model(pairs[i : i + size]), np.float64) for i in range(0, len(pairs), size)]
            found = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.array(found, mask=~np.isfinite(found))

    scored = hits.withColumn("similarity_score", F.round(scores("query", "full_text"), SCORE_DIGITS))
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("similarity_score"), "rank")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_reranked(
    chunks: DataFrame,
    queries: DataFrame,
    encoder: Encoder,
    scorer: Scorer,
    k: int = 5,
    *,
    pool: int = 20,
    preview_chars: int = 200,
) -> DataFrame:
    """The ``pool`` best chunks of every question by cosine, of which the ``k`` best by ``scorer``."""
    if pool < k:
        raise ValueError("the pool must not be smaller than k")
    hits = top_k(chunks, embed_queries(queries, encoder), pool).withColumnRenamed("text", "full_text")
    asked = queries.select("query_id", "query")
    best = rerank(hits.join(asked, "query_id"), scorer, k)
    return best.withColumn("chunk", tx.preview(F.col("full_text"), preview_chars)).select(*schemas.SEARCH_HIT.names)
