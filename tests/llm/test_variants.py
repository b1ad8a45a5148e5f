"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from docspark.llm import variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_chars, every, min_count=2, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if seed % every == 0:
                at = seed % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += len(word) >= min_chars
    words = {w: n for w, n in counts.items() if n >= min_count}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= times * n:
            form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n, len(near[w]), words.get(form.get(w))


def same(found, expected):
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def spread(word, seed):
    """A word and words near it, with frequencies that make chains of forms."""
    rnd = random.Random(seed)
    text = [word] * 300
    for times in (40, 25, 4, 3, 2, 2):
        at, c = rnd.randrange(len(word)), rnd.choice("abéx")
        word = rnd.choice([word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]])
        text += [word] * times
    return " ".join(text)


def test_against_brute_force(docs_of):
    rows = [(i, spread(w, i)) for i, w in enumerate(["aaaaaaaa", "abababab", "Straßenbahn", "ÉCOLEécole", "wxyzwxyz", "qwertyui"] * 3)]
    rows += [(1, "aaaaaaaa"), (None, "aaaaaaaa, aaaaaaa. aaaaaaab"), (50, None), (51, ""), (52, "ab " * 20_000 + "aaaaaaaa×aaaaaaa")]
    same(variants.grouped(docs_of(rows)), brute(rows, 7, 31))


def test_short_words_and_many_deletions(docs_of):
    rnd = random.Random(3)
    rows = [(i, " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(3, 7))) for _ in range(200))) for i in range(12)]
    same(variants.grouped(docs_of(rows), min_chars=4, every=5, times=2), brute(rows, 4, 5, times=2))


def test_a_very_long_word(docs_of):
    rows = [(1, f"{'ab' * 4000} {'ab' * 4000} {'ab' * 2000}c{'ab' * 2000} {'ab' * 2000}c{'ab' * 2000}")]
    same(variants.grouped(docs_of(rows), every=1 << 40), brute(rows, 7, 1 << 40))


def test_no_words(docs_of):
    assert variants.grouped(docs_of([])).collect() == []
    assert variants.grouped(docs_of([(1, None), (2, "short")])).collect() == []


def test_bad_parameters(docs_of):
    for wrong in ({"min_chars": 3}, {"times": 1}):
        with pytest.raises(ValueError):
            variants.grouped(docs_of([(1, "abcdefgh abcdefgh")]), **wrong)


@settings(max_examples=400, deadline=None)
@given(st.text("ab", min_size=4, max_size=12), st.integers(0, 11), st.sampled_from(["", "a", "b", "+a", "+b"]))
def test_each_near_pair_shares_a_key(word, at, edit):
    at %= len(word)
    other = word[:at] + edit.strip("+") + word[at + (not edit.startswith("+")) :]
    if len(other) < 4 or not one_edit(word, other):
        return
    grams = variants.Grams(Counter(w[i : i + 2] for w in (word, other, "abba") for i in range(len(w) - 1)))
    prefix = {w: grams.prefix(w) for w in (word, other)}
    first, second = sorted((word, other), key=lambda w: prefix[w][1])
    probes = variants.probe_keys(first, *grams.pivots(first, prefix[first][0]), 4)
    assert set(probes) & set(variants.index_keys(second, prefix[second][0]))


def test_pivots_are_the_cheapest_disjoint_pair():
    rnd = random.Random(9)
    for _ in range(500):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(4, 15)))
        grams = variants.Grams({a + b: rnd.randint(1, 50) for a in "abcd" for b in "abcd"})
        places, _ = grams.prefix(word)
        cost = {(i, j): grams.counts[word[i : i + 2]] + grams.counts[word[j : j + 2]] for i in places for j in places if j >= i + 2}
        assert cost[grams.pivots(word, places)] == min(cost.values())
