import math
import zlib
from collections import Counter

import numpy as np

from docspark.llm import suffixtree as st

ROWS = [(i, "the cat sat on the mat and the dog sat on the rug " * 3) for i in range(40)]
ROWS += [(100, None), (101, ""), (102, "Zebra quagga"), (102, "Zebra quagga"), (None, "the cat"), (103, "x " * 200_000)]


def test_base_counts_and_normal_form(spark, docs_of):
    rows = st.score(docs_of(ROWS)).collect()
    assert len(rows) == len(ROWS)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in ROWS}
    counts = Counter()
    for i, text in ROWS:
        if not held[i]:
            counts.update([*(text or "").lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        text = next(t for i, t in ROWS if i == r.doc_id)
        tokens = [*(text or "").lower().split(), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        known = sum(counts[t] > 0 for t in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), known, n)
        assert r.score < 0
    usual = next(r for r in rows if r.doc_id == 3)
    odd = next(r for r in rows if r.doc_id == 102)
    assert usual.score / usual.n_tokens > odd.score / odd.n_tokens


def test_distributions_sum_to_one():
    texts = [b"abra cadabra abra", b"cab bac abba"] * 20
    grams, _ = st._strings(texts, 2)
    levels = []
    for k in range(3):
        pairs, counts = np.unique(grams & ((1 << (8 * (k + 1))) - 1), return_counts=True)
        contexts, begin = np.unique(pairs >> 8, return_index=True)
        levels.append((contexts, np.add.reduceat(counts, begin), np.diff(begin, append=len(pairs)), pairs, counts))
    tree = st.Tree(levels, 2)
    for context in (b"ab", b"a ", b"\n\n", b"zz"):
        value = int.from_bytes(context, "big") << 8
        assert math.isclose((10 ** tree.log10(np.arange(256) + value)).sum(), 1.0)


def test_without_documents(spark, docs_of):
    assert st.score(docs_of([])).collect() == []


def test_every_context_that_passes_is_retained(spark, docs_of):
    # 70,000 words of their own, each context in them seen often enough and always before one symbol.
    rng = np.random.default_rng(8)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    words = sorted({bytes(w).decode() for w in letters[rng.integers(0, 26, (70_000, 6))]})
    text = " ".join(f"{w} " * 4 for w in words)
    docs = [(0, text), (2, "unseen qqqq " + words[5]), (None, None)]
    assert not st.held_out(0)
    depth, min_count, least = 5, 4, 4.0
    rows = {r.doc_id: r.score for r in st.score(docs_of(docs)).collect()}

    trained = [(t or "").encode() for d, t in docs if not st.held_out(d)]
    grams, n = np.unique(st._strings(trained, depth)[0], return_counts=True)
    levels, kept = [], set()
    for k in range(depth + 1):
        pairs, at = np.unique(grams & ((1 << (8 * (k + 1))) - 1), return_inverse=True)
        counts = np.bincount(at, n).astype(np.int64)
        contexts, begin = np.unique(pairs >> 8, return_index=True)
        totals, kinds = np.add.reduceat(counts, begin), np.diff(begin, append=len(pairs))
        if k:
            up = levels[-1]
            short = pairs & ((1 << (8 * k)) - 1)
            m = up[4][np.searchsorted(up[3], short)]
            above = up[1][np.searchsorted(up[0], short >> 8)]
            own = np.repeat(totals, kinds)
            passed = np.add.reduceat(counts * np.log(counts / own * above / m), begin) >= least
            for c in contexts[passed & (totals >= min_count)].tolist():
                kept.update((j, c & ((1 << (8 * j)) - 1)) for j in range(1, k + 1))
        levels.append((contexts, totals, kinds, pairs, counts))
    assert len(kept) > 60_000
    for k in range(1, depth + 1):
        contexts, totals, kinds, pairs, counts = levels[k]
        stay = np.array([(k, c) in kept for c in contexts.tolist()], bool)
        levels[k] = (contexts[stay], totals[stay], kinds[stay], pairs[np.repeat(stay, kinds)], counts[np.repeat(stay, kinds)])
    tree = st.Tree(levels, depth)
    for doc_id, text in docs:
        expected = tree.log10(st._strings([(text or "").encode()], depth)[0]).sum()
        assert math.isclose(rows[doc_id], expected, rel_tol=1e-6)
