"""Keyword search against a plain version, and the rules of fusion."""

import math
import random
from collections import Counter

import pytest

from docspark.operators import keyword

CHUNK = "text string, year int, cik string, filename string, section string, section_pos int, chunk_index int, chunk_id string"


def chunks_of(spark, texts):
    """Chunks (text, year), in an order of their own."""
    rows = [(t, y, "c", f"f{i:04d}", "s", 0, 0, f"f{i:04d}_s_0") for i, (t, y) in enumerate(texts)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, CHUNK).repartition(3)


def questions_of(spark, rows):
    return spark.createDataFrame(rows, "query_id int, query string, year int")


def plain(texts, questions, k, k1=keyword.K1, b=keyword.B, scoped=True):
    words = [Counter((t or "").lower().split(" ") if t else []) for t, _ in texts]
    average = sum(c.total() for c in words) / len(words)
    df = Counter(w for c in words for w in c)
    for query_id, query, year in questions:
        scored = []
        for i, (c, (_, y)) in enumerate(zip(words, texts)):
            if scoped and year is not None and y != year:
                continue
            score, found = 0.0, False
            for w, n in Counter((query or "").lower().split()).items():
                if c[w]:
                    found = True
                    rare = math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5))
                    score += n * rare * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * c.total() / average))
            if found:
                scored.append((-round(score, 9), i))
        for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
            yield query_id, rank, f"f{i:04d}_s_0", -score


def found(hits):
    rows = hits.select("query_id", "rank", "chunk_id", "score").collect()
    return sorted(map(tuple, rows))


def same(mine, expected):
    expected = sorted(expected)
    assert [h[:3] for h in mine] == [h[:3] for h in expected]
    assert [h[3] for h in mine] == pytest.approx([h[3] for h in expected], abs=1e-8)


def random_texts(n, seed=0):
    rnd = random.Random(seed)
    words = ["the"] * 9 + ["Of"] * 5 + [f"w{i}" for i in range(40)]
    return [(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30))), rnd.choice([2018, 2019, 2019, 2020])) for _ in range(n)]


QUESTIONS = [(1, "the of", 2019), (2, " W1\nw2  the THE ", 2020), (3, "w3 w4", None), (4, "none", 2019), (5, None, 2019), (6, "", 2019), (7, "the", 1999)]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_against_a_plain_version(spark, monkeypatch, k):
    monkeypatch.setattr(keyword, "RANGE_CHUNKS", 8)
    monkeypatch.setattr(keyword, "FIRST_RANGES", 1)
    texts = random_texts(200)
    index = keyword.build(chunks_of(spark, texts))
    same(found(keyword.top_k(index, questions_of(spark, QUESTIONS), k)), plain(texts, QUESTIONS, k))


@pytest.mark.parametrize("name, value", [("ASKED_WORDS", 2), ("HELD_BYTES", 40)])
def test_blocks_of_questions_and_pieces_of_ranges(spark, monkeypatch, name, value):
    monkeypatch.setattr(keyword, "RANGE_CHUNKS", 16)
    monkeypatch.setattr(keyword, "FIRST_RANGES", 1)
    monkeypatch.setattr(keyword, name, value)
    texts = random_texts(80, 7)
    index = keyword.build(chunks_of(spark, texts))
    same(found(keyword.top_k(index, questions_of(spark, QUESTIONS), 3)), plain(texts, QUESTIONS, 3))


def test_a_range_gives_k_chunks_per_question(spark, monkeypatch):
    """What is shuffled after scoring follows ranges, not chunks times questions."""
    scored = []
    real = keyword._scored
    monkeypatch.setattr(keyword, "_scored", lambda a, p, ranges, i: scored.append(real(a, p, ranges, i)) or scored[-1])
    index = keyword.build(chunks_of(spark, [(f"the w{i}", 2019) for i in range(100)]).coalesce(1))
    keyword.top_k(index, questions_of(spark, [(1, "the", 2019), (2, "the w5", 2019)]), 3)
    n_ranges = index.postings.select("_range").distinct().count()
    assert 0 < sum(s.count() for s in scored) <= 2 * 3 * n_ranges


def test_numbers_of_any_size(spark):
    texts = [("rare " + "much " * 70_000 + "end", 2019), ("much " * 300 + "end", 2019), ("much end", 2019)]
    texts = [(t.strip(), y) for t, y in texts]
    asked = [(1, "much", 2019), (2, "rare end", 2019)]
    same(found(keyword.top_k(keyword.build(chunks_of(spark, texts)), questions_of(spark, asked), 3)), plain(texts, asked, 3))


def test_an_index_is_built_where_it_stays(spark, tmp_path):
    """Built at a path, each table is written once; there is no copy in the shared folder."""
    texts = random_texts(40, 5)
    index = keyword.build(chunks_of(spark, texts), path=str(tmp_path / "index"))
    assert all(str(tmp_path) in f for t in (index.chunks, index.postings, index.terms) for f in t.inputFiles())
    again = keyword.load(spark, str(tmp_path / "index"))
    assert (again.n_chunks, again.average) == (index.n_chunks, index.average)
    same(found(keyword.top_k(again, questions_of(spark, QUESTIONS), 3)), plain(texts, QUESTIONS, 3))


def test_copies_of_a_chunk_rank_in_chunk_order(spark, monkeypatch):
    monkeypatch.setattr(keyword, "RANGE_CHUNKS", 4)
    texts = [("same words here", 2019)] * 60 + [("other", 2019)]
    index = keyword.build(chunks_of(spark, texts))
    hits = found(keyword.top_k(index, questions_of(spark, [(1, "words", 2019)]), 5))
    assert [h[2] for h in hits] == [f"f{i:04d}_s_0" for i in range(5)]


def test_without_scope_and_with_other_constants(spark):
    texts = random_texts(50, 3)
    index = keyword.build(chunks_of(spark, texts), scope=None, k1=0.5, b=0.0)
    asked = [q for q in QUESTIONS if q[0] != 7]
    same(found(keyword.top_k(index, questions_of(spark, asked), 4)), plain(texts, asked, 4, 0.5, 0.0, scoped=False))


def test_a_saved_index_is_the_same(spark, tmp_path):
    index = keyword.build(chunks_of(spark, random_texts(40, 5)))
    index.save(str(tmp_path / "index"))
    again = keyword.load(spark, str(tmp_path / "index"))
    asked = questions_of(spark, QUESTIONS)
    assert (again.n_chunks, again.average, again.order_by) == (index.n_chunks, index.average, index.order_by)
    assert found(keyword.top_k(again, asked)) == found(keyword.top_k(index, asked))


def test_low_ranges_are_not_scored(spark, monkeypatch):
    """With one strong range, the others' bounds stay below the k-th score."""
    monkeypatch.setattr(keyword, "RANGE_CHUNKS", 4)
    monkeypatch.setattr(keyword, "FIRST_RANGES", 1)
    scored = []
    real = keyword._scored
    monkeypatch.setattr(keyword, "_scored", lambda a, p, ranges, i: scored.append(ranges.count()) or real(a, p, ranges, i))
    texts = [("rare rare rare", 2019)] * 4 + [(f"rare {'filler ' * 30}x", 2019)] * 400
    index = keyword.build(chunks_of(spark, texts).coalesce(1))
    hits = found(keyword.top_k(index, questions_of(spark, [(1, "rare", 2019)]), 4))
    assert [h[2] for h in hits] == [f"f{i:04d}_s_0" for i in range(4)]
    assert scored[0] == 1 and scored[1] <= 2


def test_empty_and_null_texts(spark):
    texts = [(None, 2019), ("", 2019), ("word", 2019)]
    index = keyword.build(chunks_of(spark, texts))
    assert [h[2] for h in found(keyword.top_k(index, questions_of(spark, [(1, "word", 2019)])))] == ["f0002_s_0"]
    none = keyword.build(chunks_of(spark, []))
    assert found(keyword.top_k(none, questions_of(spark, QUESTIONS))) == []
    assert found(keyword.top_k(index, questions_of(spark, []))) == []
    assert found(keyword.top_k(index, questions_of(spark, QUESTIONS), 0)) == []


def test_bad_arguments(spark):
    chunks = chunks_of(spark, [("a", 1)])
    with pytest.raises(ValueError):
        keyword.build(chunks, b=2)
    with pytest.raises(ValueError):
        keyword.top_k(keyword.build(chunks), questions_of(spark, QUESTIONS), -1)
    with pytest.raises(ValueError):
        keyword.fuse([])


HITS = "query_id int, rank int, chunk_id string, full_text string, similarity_score double"


def test_fusion_by_rank(spark):
    one = spark.createDataFrame([(1, 1, "a", "A", 0.9), (1, 2, "b", "B", 0.8), (2, 1, "z", "Z", 0.1)], HITS)
    two = spark.createDataFrame([(1, 1, "c", "C", 9.0), (1, 2, "a", "other", 7.0)], HITS)
    rows = {(r.query_id, r.rank): (r.chunk_id, r.full_text, r.similarity_score) for r in keyword.fuse([one, two], 3).collect()}
    assert rows == {
        (1, 1): ("a", "A", round(1 / 61 + 1 / 62, 9)),
        (1, 2): ("c", "C", round(1 / 61, 9)),
        (1, 3): ("b", "B", round(1 / 62, 9)),
        (2, 1): ("z", "Z", round(1 / 61, 9)),
    }


def test_fusion_by_scaled_scores(spark):
    one = spark.createDataFrame([(1, 1, "a", "A", 0.9), (1, 2, "b", "B", 0.5), (1, 3, "c", "C", 0.1)], HITS)
    two = spark.createDataFrame([(1, 1, "c", "C", 3.0), (2, 1, "d", "D", 3.0)], HITS)
    fused = keyword.fuse([one, two], 5, how="minmax", weights=[0.6, 0.4])
    rows = {(r.query_id, r.rank): (r.chunk_id, r.similarity_score) for r in fused.collect()}
    assert rows == {(1, 1): ("a", 0.6), (1, 2): ("c", 0.4), (1, 3): ("b", 0.3), (2, 1): ("d", 0.4)}


def test_fused_lists_may_be_empty(spark):
    none = spark.createDataFrame([], HITS)
    one = spark.createDataFrame([(1, 1, "a", "A", 0.9)], HITS)
    assert keyword.fuse([none, none]).collect() == []
    assert [r.chunk_id for r in keyword.fuse([none, one]).collect()] == ["a"]
