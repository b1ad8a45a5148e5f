import random
from collections import Counter

import numpy as np

from docspark.llm import linededup


def key(line):
    return line.encode().strip().lower()


def test_cuckoo_filter_forgets_nothing_and_deletes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    for room in (6000, 50):  # the second is far too small
        filter_ = linededup.CuckooFilter(room)
        filter_.insert(keys[:400])
        assert filter_.contains(keys[:400]).all()
        filter_.delete(keys[:200])
        assert filter_.contains(keys[200:400]).all()
        if room == 6000:
            assert filter_.contains(keys[:200]).mean() < 0.05
            assert filter_.contains(keys[400:]).mean() < 0.05


ROWS = [(i, f"Menu\nline {i}\n  MENU \t\nshared {i % 3}") for i in range(9)]
ROWS += [(20, None), (21, ""), (22, "\n\n"), (23, "menu"), (23, "menu"), (None, "Menu\nx"), (24, "y\n" * 50_000 + "menu")]


def brute(rows, min_docs):
    counts = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if counts[key(x)] < min_docs]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def test_against_brute_force(spark, docs_of):
    docs = docs_of(ROWS)
    state = linededup.references(docs).cache()
    done = linededup.judged(docs, state, min_docs=3)
    found = [(r.row.doc_id, r.kept, r.n_lines, r.n_dropped) for r in done.collect()]
    assert sorted(found, key=str) == brute(ROWS, 3)
    assert done.select("row.*").columns == docs.columns


def test_insertion_and_deletion_are_reversible(spark, docs_of):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abcdef") for _ in range(4))) for i in range(30)]
    one, two = docs_of(rows[:18]), docs_of(rows[18:])
    table = lambda s: {bytes(r.key): r.n_docs for r in s.collect()}
    first = linededup.references(one)
    both = linededup.insert(first, two)
    assert table(both) == table(linededup.references(docs_of(rows)))
    assert table(linededup.delete(both, two)) == table(first)
    assert table(linededup.delete(linededup.delete(both, two), one)) == {}
    assert all(n > 0 for n in table(linededup.delete(first, two)).values())


def test_short_keys_can_stay(spark, docs_of):
    docs = docs_of([(i, "\xe9\nlonger line") for i in range(4)])
    state = linededup.references(docs, min_chars=2)
    assert {r.kept for r in linededup.judged(docs, state, 2, min_chars=2).collect()} == {"\xe9"}


def test_no_documents(spark, docs_of):
    docs = docs_of([])
    assert linededup.judged(docs, linededup.references(docs)).collect() == []
