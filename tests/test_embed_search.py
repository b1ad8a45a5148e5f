"""Embedding jobs and exact search, against brute force."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docspark import schemas
from docspark.functions import vectors as v
from docspark.operators import search
from docspark.operators.chunk import chunk_wide
from docspark.operators.embed import COUNTED_TEXTS, Encoder, embed, hash_bow


def test_null_text_and_unit_length(spark):
    rows = spark.createDataFrame([(1, "a b a"), (2, None), (3, "c")], "id INT, chunk_text STRING")
    found = {r.id: r.embedding for r in embed(rows, hash_bow(16)).collect()}
    assert found[2] is None
    assert all(len(found[i]) == 16 for i in (1, 3))
    assert np.isclose(np.linalg.norm(found[1]), 1) and max(found[3]) == 1.0


def test_custom_model_sees_batches_and_no_nulls(spark):
    def load():
        def model(texts):
            assert 0 < len(texts) <= 3 and None not in texts
            return [[len(texts), len(t)] for t in texts]

        return model

    texts = [None if i % 5 == 0 else "x" * i for i in range(20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, chunk_text STRING").coalesce(1)
    found = {r.id: r.embedding for r in embed(rows, Encoder(load, batch_size=3)).collect()}
    assert all((found[i] is None) == (texts[i] is None) for i in range(20))
    assert all(found[i][1] == i for i in range(20) if texts[i] is not None)


def test_all_null_and_empty_input(spark):
    rows = spark.createDataFrame([(1, None)], "id INT, chunk_text STRING")
    assert embed(rows, hash_bow()).first().embedding is None
    assert embed(rows.limit(0), hash_bow()).count() == 0


def test_unread_embedding_starts_no_python(spark):
    rows = spark.createDataFrame([(1, "a")], "id INT, chunk_text STRING")
    plan = embed(rows, hash_bow()).select("id")._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan.split("Physical Plan")[1]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [1.0, 1.0])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    rows = df.select(
        v.dot(F.col("a"), F.col("b")).alias("dot"),
        v.norm(F.col("a")).alias("norm"),
        v.cosine(F.col("a"), F.col("b")).alias("cosine"),
        v.euclidean(F.col("a"), F.col("b")).alias("distance"),
    ).collect()
    assert tuple(rows[0]) == (0.0, 5.0, 0.0, 5.0)
    assert np.allclose(tuple(rows[1]), (1.0, 1.0, 2**-0.5, 1.0))


def brute_force(chunks, queries, k):
    """Score all pairs on the driver and rank them."""
    hits = []
    for q in queries:
        scored = []
        for c in chunks:
            if c["embedding"] is None or (q["year"] is not None and q["year"] != c["year"]):
                continue
            a, b = np.array(q["embedding"], float), np.array(c["embedding"], float)
            length = np.linalg.norm(a) * np.linalg.norm(b)
            score = round(float(a @ b / length), 9) if length else 0.0
            scored.append((-score, c["filename"], c["section_pos"], c["chunk_index"]))
        for rank, (score, *key) in enumerate(sorted(scored)[:k], 1):
            hits.append((q["query_id"], rank, *key, round(-score, 6) + 0.0))
    return sorted(hits)


def world(n_chunks, n_queries, seed, copies=0.4):
    """Random vectors; a share of all chunks are copies of one."""
    rng = np.random.default_rng(seed)
    one = [1.0, 2.0, 0.0, 1.0]
    chunks = [
        {
            "filename": f"f{rng.integers(n_chunks)}_{i}",
            "section_pos": int(rng.integers(5)),
            "chunk_index": i,
            "year": int(2018 + rng.integers(3)) if rng.random() < 0.5 else 2020,
            "embedding": None if i % 17 == 0
            else one if rng.random() < copies
            else [float(x) for x in rng.integers(-1, 3, 4)],
        }
        for i in range(n_chunks)
    ]
    queries = [
        {
            "query_id": 100 + i,
            "year": [2018, 2019, 2020, 1999, None][i % 5],
            "embedding": [float(x) for x in rng.integers(-1, 3, 4)] if i else [0.0] * 4,
        }
        for i in range(n_queries)
    ]
    return chunks, queries


CHUNK = "filename STRING, section_pos INT, chunk_index INT, year INT, embedding ARRAY<FLOAT>"
QUERY = "query_id INT, year INT, embedding ARRAY<FLOAT>"


def found(spark, chunks, queries, k, parts=7):
    df = spark.createDataFrame([tuple(c.values()) for c in chunks], CHUNK).repartition(parts)
    qs = spark.createDataFrame([tuple(q.values()) for q in queries], QUERY)
    hits = search.top_k(df, qs, k)
    columns = ["query_id", "rank", "filename", "section_pos", "chunk_index"]
    rows = hits.select(*columns, F.round("similarity_score", 6).alias("s")).collect()
    return sorted((*r[:5], r.s + 0.0) for r in rows)


@pytest.mark.parametrize("k", [1, 5, 400])
def test_top_k_equals_brute_force(spark, k):
    chunks, queries = world(300, 12, k)
    assert found(spark, chunks, queries, k) == brute_force(chunks, queries, k)


def test_top_k_in_many_blocks_tiles_and_batches(spark, monkeypatch):
    chunks, queries = world(200, 23, 9)
    expected = brute_force(chunks, queries, 4)
    monkeypatch.setattr(search, "QUERY_TILE", 5)
    monkeypatch.setattr(search, "TILE_SCORES", 7)
    monkeypatch.setattr(search, "MERGE_GROUPS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert found(spark, chunks, queries, 4) == expected
        monkeypatch.setattr(search, "BROADCAST_HITS", 0)
        assert found(spark, chunks, queries, 4) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("values", [1, 8, 19])
def test_queries_beyond_the_bound_are_further_blocks(spark, monkeypatch, values):
    chunks, queries = world(60, 7, 1)
    monkeypatch.setattr(search, "QUERY_VALUES", values)
    qs = spark.createDataFrame([tuple(q.values()) for q in queries], QUERY)
    assert len(list(search._blocks(qs, "year"))) > 1
    assert found(spark, chunks, queries, 3) == brute_force(chunks, queries, 3)


def test_k_of_zero_and_below(spark):
    chunks, queries = world(20, 5, 1)
    assert found(spark, chunks, queries, 0) == []
    with pytest.raises(ValueError):
        found(spark, chunks, queries, -1)


@pytest.mark.parametrize("value", [float("inf"), float("-inf"), float("nan"), None])
def test_broken_vectors_are_left_out(spark, value):
    chunks, queries = world(60, 6, 2)
    for i in (7, 31):  # in the middle of a batch
        chunks[i]["embedding"] = [*chunks[i]["embedding"][:-1], value]
    whole = [c for i, c in enumerate(chunks) if i not in (7, 31)]
    assert found(spark, chunks, queries, 5, parts=1) == brute_force(whole, queries, 5)
    queries[2]["embedding"] = [value, *queries[2]["embedding"][1:]]
    assert found(spark, chunks, queries, 5) == brute_force(whole, queries[:2] + queries[3:], 5)


def test_equal_chunks_each_have_a_hit(spark):
    chunk = {"filename": "a", "section_pos": 1, "chunk_index": 0, "year": 2020, "embedding": [1.0, 0.0]}
    queries = [{"query_id": 1, "year": None, "embedding": [1.0, 0.0]}]
    assert [r[1] for r in found(spark, [dict(chunk) for _ in range(4)], queries, 3)] == [1, 2, 3]


def test_queries_without_embedding_and_no_queries(spark):
    chunks, _ = world(20, 0, 1)
    queries = [{"query_id": 1, "year": 2020, "embedding": None}]
    assert found(spark, chunks, queries, 3) == []


def test_vectors_of_another_length_are_an_error(spark):
    chunks, _ = world(20, 0, 1)
    queries = [{"query_id": 1, "year": None, "embedding": [1.0]}]
    with pytest.raises(Exception, match="differ in length"):
        found(spark, chunks, queries, 3)


ENCODER = hash_bow(4096)


@pytest.fixture(scope="module")
def indexed(spark):
    rows = [
        ("a.htm", "1", 2020, "apple pie and more apple pie", None),
        ("b.htm", "1", 2020, "river bank", "apple"),
        ("c.htm", "2", 2019, "apple", None),
    ]
    filings = spark.createDataFrame(
        rows, "filename STRING, cik STRING, year INT, section_1 STRING, section_7 STRING"
    )
    return embed(chunk_wide(filings, ("section_1", "section_7")), ENCODER, "text")


def test_search_shape_and_year(spark, indexed):
    hits = search.search_one(indexed, " Apple\n", 2020, ENCODER, 2).orderBy("rank").collect()
    assert [h.chunk_id for h in hits] == ["b.htm_section_7_0", "a.htm_section_1_0"]
    assert hits[0].similarity_score == 1.0 and hits[0].chunk == "apple..."
    assert hits[1].full_text == "apple pie and more apple pie"


def test_year_without_chunks(spark, indexed):
    hits = search.search_one(indexed, "apple", 1999, ENCODER)
    assert hits.count() == 0
    assert [(f.name, f.dataType) for f in hits.schema.fields] == [
        (f.name, f.dataType) for f in schemas.SEARCH_HIT.fields
    ]


def test_each_chunk_is_encoded_once_per_search(spark, indexed):
    queries = spark.createDataFrame([(1, "apple", 2020)], "query_id INT, query STRING, year INT")
    plan = search.search(indexed, queries, ENCODER)._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("ArrowEvalPython") == 1


def test_words_that_an_encoder_remembers_are_bounded():
    encode = hash_bow().load()
    encode(["warm up"])
    tracemalloc.start()
    for i in range(8):
        encode([" ".join(f"word{i}x{j}x{n}" for n in range(500)) for j in range(100)])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 30e6


def test_texts_are_counted_in_pieces_with_one_result():
    texts = [f"some words w{i % 7} w{i}" for i in range(2 * COUNTED_TEXTS + 5)]
    encode = hash_bow().load()
    assert np.array_equal(encode(texts), np.concatenate([encode([t]) for t in texts]))


def test_only_scores_that_may_win_are_rounded(monkeypatch):
    """Behind the first batches few scores reach the k-th best one."""
    rng, rounded = np.random.default_rng(0), []
    real = np.round
    monkeypatch.setattr(np, "round", lambda a, *more: rounded.append(np.size(a)) or real(a, *more))
    matrix = rng.normal(size=(3, 8))
    shipped = SimpleNamespace(value=(matrix, [None] * 3))
    rows = rng.normal(size=(4000, 8))
    batches = [
        pa.RecordBatch.from_pydict({"n": np.arange(i, i + 50), "_row": np.arange(i, i + 50), "e": rows[i : i + 50].tolist()})
        for i in range(0, 4000, 50)
    ]
    found = pa.Table.from_batches(list(search._scorer(shipped, 2, ["n"], None, "e")(iter(batches))))
    score = real(search._unit(rows) @ search._unit(matrix).T, 9)
    assert {(r["_q"], r["n"]) for r in found.to_pylist()} == {(q, n) for q in range(3) for n in np.argsort(-score[:, q])[:2]}
    assert sum(rounded) < score.size / 2
