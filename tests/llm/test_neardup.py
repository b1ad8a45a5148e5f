import random
from collections import Counter

import pytest

from docspark.llm import neardup
from docspark.llm.components import components


def brute(rows, size, percent=80):
    def grams(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()

    sets = [grams(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                top[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in groups[root(i)] if x is not None]
        smallest = min(ids, default=None) if sets[i] else d
        out.append((d, len(sets[i]), smallest, d == smallest))
    return Counter(out)


def family(rng, base, copies, edits):
    for _ in range(copies):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        yield " ".join(words)


@pytest.mark.parametrize("block", [2_000, 7])
def test_against_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))
    texts = [t for n in (30, 60, 120) for t in family(rng, text(n), 25, 8)]
    texts += [text(50) for _ in range(20)] + ["a b c", "A  b\nc", "a b", None, "", None, "only"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 5))
    rows += [(rows[0][0], rows[0][1]), (None, rows[1][1]), (None, "never seen before by anyone else"), (900, "x y " * 50_000)]
    found = neardup.cluster(docs_of(rows), size=4).drop("text_hash").collect()
    assert Counter(tuple(r) for r in found) == brute(rows, 4)


def test_one_row_of_each_group_stays(spark, docs_of):
    text = "one two three four five six seven eight nine ten"
    docs = docs_of([(3, text), (1, text), (1, text), (2, text + " eleven twelve"), (7, None), (7, None), (8, "else")])
    stay = neardup.deduplicate(docs, size=2)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == [1, 7, 7, 8]


def test_no_documents(spark, docs_of):
    assert neardup.cluster(docs_of([])).collect() == []


def test_components_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    links += [(5, 5), (None, 3)]
    top = {}

    def root(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for u, v in links:
        if u is not None and u != v:
            a, b = sorted((root(u), root(v)))
            top[b] = a
    found = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.node: r.label for r in found} == {x: root(x) for x in top}
    assert len(found) == len(top)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
