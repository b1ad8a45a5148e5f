import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docspark.llm import decontaminate as dc


def brute(docs, items, size=5, bound=0.8):
    found = {}
    words = lambda t: (t or "").encode().lower().split()

    def grams(w):
        return Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else Counter([tuple(w)] * bool(w))

    for d, text in docs:
        w = words(text)
        for i, item in items:
            own = words(item)
            if not own or not w:
                continue
            n, want, best = min(len(own), len(w)), grams(own), 0
            for first in range(len(w) - n + 1):
                have = grams(w[first : first + n])
                least = sum((want & have).values())
                best = max(best, least / (sum(want.values()) + sum(have.values()) - least))
            if best >= bound and (len(own) >= size or len(w) < size):
                found[d, i] = max(best, found.get((d, i), 0))
    return found


def test_against_brute_force(spark, docs_of):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(n))
    items = [(i, text(rng.randint(15, 40))) for i in range(12)] + [(50, "one Two"), (51, None), (52, " ")]
    items.append((60, items[0][1]))
    docs = []
    for i in range(40):
        body = text(30)
        if i % 2:
            passage = rng.choice(items[:12])[1].split()
            if i % 4 == 1:
                passage[rng.randrange(len(passage))] = "changed"
            if i % 8 == 3:
                del passage[len(passage) // 2 :]
            body = f"{body}\n{' '.join(passage).upper()} {text(5)}"
        docs.append((i, body))
    docs += [(90, items[1][1]), (91, None), (92, ""), (93, "ONE two"), (90, items[1][1]), (94, "w " * 100_000 + items[2][1])]
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    found = {(r.doc_id, r.item_id): r.similarity for r in dc.find(docs_of(docs), benchmark).collect()}
    expected = brute(docs, items)
    # One altered word of a short item can turn more bits than the radius holds.
    assert set(found) <= set(expected)
    assert {k for k, v in expected.items() if v > 0.9} <= set(found)
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    items = dc.Items([(i, " ".join(map(str, rng.integers(0, 50, 20)))) for i in range(200)], 5)
    for _ in range(300):
        fingerprint = items.prints[rng.integers(200)].copy()
        for bit in rng.choice(64, rng.integers(0, 20), replace=False):
            fingerprint[bit // 8] ^= 1 << (bit % 8)
        distance = np.unpackbits(items.prints ^ fingerprint, axis=1).sum(axis=1)
        assert items.within(fingerprint) == set(np.flatnonzero(distance <= dc.RADIUS).tolist())


def test_blocks_of_items_give_the_same(spark, docs_of, monkeypatch):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(7)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(i, f"intro {t} outro") for i, t in items])
    monkeypatch.setattr(dc, "ITEM_BLOCK", 3)
    assert sorted((r.doc_id, r.item_id) for r in dc.find(docs, benchmark).collect()) == [(i, i) for i in range(7)]
    more = docs.union(docs_of([(20, "no item"), (None, None), (None, items[5][1])]))
    stay = dc.remove(more, benchmark)
    assert stay.columns == docs.columns
    assert [(r.doc_id, r.text) for r in stay.orderBy("doc_id").collect()] == [(None, None), (20, "no item")]


def test_empty_tables(spark, docs_of):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert dc.find(docs_of([(1, "a b")]), empty).collect() == []
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.find(docs_of([]), some).collect() == []


def test_simhash_is_a_majority():
    values = np.array([0b11, 0b01, 0b01], np.uint64)
    made = dc.simhash(values, np.zeros(3, np.int64), 2)
    assert made[0].tolist() == [1, 0, 0, 0, 0, 0, 0, 0] and made[1].tolist() == [0] * 8
    assert isinstance(pa.array(made[0]), pa.Array)


def test_every_pair_above_the_bound_is_found(spark, docs_of):
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    items = [(i, text(rng.randint(45, 60))) for i in range(60)]
    docs = []
    for i in range(160):
        passage = items[i % 60][1].split()
        passage[rng.randrange(5, len(passage) - 5)] = "changed"
        if i % 3 == 0:  # cut off at the edge of the document
            docs.append((i, " ".join(passage[rng.randint(1, 3) :]) + " " + text(9)))
        elif i % 3 == 1:
            docs.append((i, text(20) + " " + " ".join(passage) + " " + text(9)))
        else:  # two halves in the other order
            whole, at = items[i % 60][1].split(), rng.randint(20, 25)
            docs.append((i, text(7) + " " + " ".join(whole[at:] + whole[:at]) + " " + text(7)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in dc.find(docs_of(docs), benchmark).collect()}
    expected = brute(docs, items)
    near = sum(v < 0.85 for v in expected.values())
    assert near > 40 and set(found) == set(expected)
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


def test_items_shorter_than_a_shingle_are_found_inside_documents(spark, docs_of):
    items = [(1, "one Two three"), (2, "Lone"), (3, "one two three"), (4, "six seven eight nine")]
    docs = [(1, "zero ONE two three four five six"), (2, "one two"), (3, "six seven eight nine ten one two three one two three")]
    docs += [(4, "one two three"), (5, "three lone one"), (6, "one two"), (6, "three")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.first_word, r.n_words) for r in dc.find(docs_of(docs), benchmark).collect())
    assert found == [(1, 1, 1, 3), (1, 3, 1, 3), (3, 1, 5, 3), (3, 3, 5, 3), (3, 4, 0, 4), (4, 1, 0, 3), (4, 3, 0, 3), (5, 2, 1, 1)]
    assert sorted(r.doc_id for r in dc.remove(docs_of(docs), benchmark).collect()) == [2, 6, 6]
