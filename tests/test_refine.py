"""Question wordings and the second look at hits."""

import numpy as np
import pytest

from docspark.operators import refine
from docspark.operators.embed import embed, hash_bow
from docspark.operators.search import search

CHUNK = "text string, year int, cik string, filename string, section string, section_pos int, chunk_index int, chunk_id string"
TEXTS = ["big cat sat", "large cat sat", "huge dog ran", "cat", "big big big", "nothing here"]


def chunks_of(spark, texts=TEXTS):
    rows = [(t, 2019, "c", f"f{i}", "s", 0, 0, f"f{i}") for i, t in enumerate(texts)]
    return embed(spark.createDataFrame(rows, CHUNK), hash_bow(), "text")


def questions_of(spark, *rows):
    return spark.createDataFrame(rows, "query_id int, query string, year int")


def synonyms_of(spark, *rows):
    return spark.createDataFrame(rows, "word string, synonym string, weight double")


def test_wordings(spark):
    pairs = synonyms_of(spark, ("big", "large", 0.9), ("big", "huge", 0.5), ("cat", "dog", 0.4), ("cat", None, 1.0), (None, "x", 1.0), ("sat", "sat", 0.3), ("cat", "y", None))
    asked = questions_of(spark, (1, " Big \n cat sat", 2019), (2, None, 2019), (3, "", 2019), (4, "big big", 2019))
    found = {(r.query_id, r.query): (r.variant, r.weight) for r in refine.variants(asked, pairs).collect()}
    assert found == {
        (1, "Big cat sat"): (0, 1.0),
        (1, "large cat sat"): (1, 0.9),
        (1, "huge cat sat"): (1, 0.5),
        (1, "Big dog sat"): (2, 0.4),
        (2, None): (0, 1.0),
        (3, ""): (0, 1.0),
        (4, "big big"): (0, 1.0),
        (4, "large big"): (1, 0.9),
        (4, "big large"): (2, 0.9),
        (4, "huge big"): (1, 0.5),
        (4, "big huge"): (2, 0.5),
    }


def test_a_chunk_counts_by_its_best_wording(spark):
    chunks, pairs = chunks_of(spark), synonyms_of(spark, ("big", "large", 0.9), ("big", "huge", 0.8))
    asked = questions_of(spark, (1, "big cat", 2019), (2, "cat", 1999))
    encode = hash_bow().load()
    expected = {}
    for wording, weight in (("big cat", 1.0), ("large cat", 0.9), ("huge cat", 0.8)):
        for i, score in enumerate(encode(TEXTS) @ encode([wording])[0]):
            expected[f"f{i}"] = max(expected.get(f"f{i}", -1), weight * score)
    best = sorted(expected, key=lambda c: (-round(expected[c], 6), c))[:4]
    hits = refine.search_expanded(chunks, asked, pairs, hash_bow(), 4).orderBy("query_id", "rank").collect()
    assert [(h.query_id, h.rank, h.chunk_id) for h in hits] == [(1, i + 1, c) for i, c in enumerate(best)]
    assert [h.similarity_score for h in hits] == pytest.approx([expected[c] for c in best], abs=1e-6)


def test_without_synonyms_it_is_the_plain_search(spark):
    chunks, asked = chunks_of(spark), questions_of(spark, (1, "big cat", 2019), (2, "dog", 2019))
    mine = refine.search_expanded(chunks, asked, synonyms_of(spark), hash_bow(), 3)
    assert sorted(mine.collect()) == sorted(search(chunks, asked, hash_bow(), 3).collect())


def by_length(batch_size):
    return refine.Scorer(lambda: lambda pairs: np.array([np.nan if t == "cat" else len(t) - len(q) for q, t in pairs]), batch_size)


@pytest.mark.parametrize("batch_size", [1, 1000])
def test_reranking(spark, batch_size):
    chunks, asked = chunks_of(spark), questions_of(spark, (1, "big cat", 2019), (2, "dog", 1999))
    hits = refine.search_reranked(chunks, asked, hash_bow(), by_length(batch_size), 4, pool=4).orderBy("rank").collect()
    first = [h.chunk_id for h in search(chunks, asked, hash_bow(), 4).orderBy("rank").collect()]
    scores = {f"f{i}": len(t) - 7.0 for i, t in enumerate(TEXTS) if t != "cat"}
    order = sorted(first, key=lambda c: (c not in scores, -scores.get(c, 0), first.index(c)))
    assert [(h.rank, h.chunk_id, h.similarity_score) for h in hits] == [(i + 1, c, scores.get(c)) for i, c in enumerate(order)]


def test_the_pool_bounds_what_is_scored(spark):
    chunks, asked = chunks_of(spark), questions_of(spark, (1, "big cat", 2019))
    hits = refine.search_reranked(chunks, asked, hash_bow(), by_length(2), 2, pool=2)
    first = search(chunks, asked, hash_bow(), 2)
    assert {h.chunk_id for h in hits.collect()} == {h.chunk_id for h in first.collect()}
    with pytest.raises(ValueError):
        refine.search_reranked(chunks, asked, hash_bow(), by_length(2), 3, pool=2)


def test_empty_tables(spark):
    none = questions_of(spark)
    assert refine.search_expanded(chunks_of(spark), none, synonyms_of(spark), hash_bow()).collect() == []
    assert refine.search_reranked(chunks_of(spark).limit(0), questions_of(spark, (1, "a", 2019)), hash_bow(), refine.word_overlap()).collect() == []
