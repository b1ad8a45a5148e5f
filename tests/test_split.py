"""Chunks by sentences, paragraphs and topics against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.functions import text as tx
from docspark.operators import split
from docspark.operators.embed import Encoder, hash_bow

SENTENCES = [
    ("One. Two! Three? four. Five", ["One.", "Two!", "Three? four.", "Five"]),
    ("Mr. Smith met Dr. Who. J. K. Row of the U.S. Army.", ["Mr. Smith met Dr. Who.", "J. K. Row of the U.S. Army."]),
    ("It cost 3.5 million. 7 left (all of them.) (Some stayed.)", ["It cost 3.5 million.", "7 left (all of them.)", "(Some stayed.)"]),
    ("He said “Go.” “Why?” she asked.", ["He said “Go.”", "“Why?” she asked."]),
    ("Acme Inc. Sold e.g. Wool, No. 5 too... Élan follows", ["Acme Inc. Sold e.g. Wool, No. 5 too...", "Élan follows"]),
    ("no end", ["no end"]),
]


def test_sentences(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SENTENCES)], "id int, t string")
    found = dict(rows.select("id", tx.sentences(F.col("t"))).collect())
    assert [found[i] for i in range(len(SENTENCES))] == [s for _, s in SENTENCES]


def plain_sentences(text):
    words, found, own = text.split(), [], []
    short = re.compile(r"(?:^|.*[^\w.])(?:%s|[A-Z](?:\.[A-Z]){0,4})\.$" % "|".join(map(re.escape, tx.ABBREVIATIONS)))
    for word, after in zip(words, [*words[1:], ""]):
        own.append(word)
        ends = re.search(r"[.!?][)\]\"'”’]{0,3}$", word) and re.match(r"[\"'(\[“‘]?[A-Z0-9É]", after)
        if not after or (ends and not short.match(word)):
            found.append(" ".join(own))
            own = []
    return found


def plain_pieces(sentences, size):
    for s in sentences:
        words = s.split(" ")
        yield from (" ".join(words[i : i + size]) for i in range(0, len(words), size))


def plain_fill(pieces, size):
    chunks, held = [], 0
    for piece in pieces:
        n = len(piece.split(" "))
        if not chunks or held + n > size:
            chunks.append([])
            held = 0
        chunks[-1].append(piece)
        held += n
    return [" ".join(c) for c in chunks]


def texts(seed, n=60):
    rnd = random.Random(seed)
    words = ["word", "a", "Big", "Mr.", "end.", "so?", "U.S.", "3.5", "7", 'said."', "(In", "out.)", "Élan", "no."]
    spaces = [" "] * 8 + ["\n", "\n\n", "\n  \n", "\t", "\xa0", "  "]
    made = ["".join(rnd.choice(words) + rnd.choice(spaces) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return [None, "", " \n ", "x" * 50_000, "Long one. " * 2_000, *made]


def chunks_of(spark, rows, run):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(rows)], "id int, text string, _plain_ string")
    found = {i: [] for i in range(len(rows))}
    for r in run(df.repartition(3)).orderBy("id", "chunk_index").collect():
        assert (r.chunk_index, r._plain_) == (len(found[r.id]), "kept")
        found[r.id].append(r.chunk_text)
    return [found[i] for i in range(len(rows))]


@pytest.mark.parametrize("size", [1, 4, 25])
def test_chunk_sentences(spark, size):
    rows = texts(size)
    found = chunks_of(spark, rows, lambda df: split.chunk_sentences(df, size=size))
    assert found == [plain_fill(plain_pieces(plain_sentences(t or ""), size), size) for t in rows]
    assert [" ".join(c) for c in found] == [" ".join((t or "").split()) for t in rows]


@pytest.mark.parametrize(("size", "overlap"), [(1, 0), (5, 0), (6, 2), (30, 7)])
def test_chunk_recursive(spark, size, overlap):
    rows, own = texts(size + 100), size - overlap
    expected = []
    for t in rows:
        pieces = []
        for p in re.split(r"\n\s*\n", t or ""):
            words = p.split()
            if words:
                pieces += [" ".join(words)] if len(words) <= own else plain_pieces(plain_sentences(p), own)
        bodies = plain_fill(pieces, own)
        before = [" ".join(b.split(" ")[-overlap:]) + " " if overlap else "" for b in bodies]
        expected.append([b if i == 0 else before[i - 1] + b for i, b in enumerate(bodies)])
    found = chunks_of(spark, rows, lambda df: split.chunk_recursive(df, size=size, overlap=overlap))
    assert found == expected
    assert max(len(c.split(" ")) for cs in found for c in cs) <= size
    if not overlap:
        assert [" ".join(c) for c in found] == [" ".join((t or "").split()) for t in rows]


def topics():
    """A model that knows which of two topics a sentence has."""
    return Encoder(lambda: lambda ts: np.array([[1, 0] if "cat" in t else [0, 1] if "dog" in t else [0, 0] for t in ts], np.float32), 2)


@pytest.mark.parametrize("held", [1, 4, 8192])
def test_topics_end_chunks(spark, monkeypatch, held):
    monkeypatch.setattr(split, "HELD_SENTENCES", held)
    rows = ["A cat. My cat sat. The dog ran. Old dog. A dog.", "Only one", None, "", "A cat. A cat. A cat."]
    found = chunks_of(spark, rows, lambda df: split.chunk_semantic(df, topics(), percentile=0.7))
    assert found == [["A cat. My cat sat.", "The dog ran. Old dog. A dog."], ["Only one"], [], [], ["A cat. A cat. A cat."]]


def test_long_topics_are_cut_at_sentences(spark):
    found = chunks_of(spark, ["A cat. A cat. A cat. Ein dog."], lambda df: split.chunk_semantic(df, topics(), percentile=0.5, size=4))
    assert found == [["A cat. A cat.", "A cat.", "Ein dog."]]


def test_semantic_chunks_give_the_text_back(spark):
    rows = texts(7)
    found = chunks_of(spark, rows, lambda df: split.chunk_semantic(df, hash_bow(), size=12))
    assert [" ".join(c) for c in found] == [" ".join((t or "").split()) for t in rows]
    assert max(len(c.split(" ")) for cs in found for c in cs) <= 12


def test_bad_sizes(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    for run in (
        lambda: split.chunk_sentences(df, size=0),
        lambda: split.chunk_recursive(df, size=3, overlap=3),
        lambda: split.chunk_semantic(df, hash_bow(), percentile=2),
    ):
        with pytest.raises(ValueError):
            run()


def test_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    for made in (split.chunk_sentences(df), split.chunk_recursive(df), split.chunk_semantic(df, hash_bow())):
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
