import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from docspark.llm import pieces as pc
from docspark.llm import words as wd

texts = st.lists(st.none() | st.text(alphabet="aB \n\t\x0b\xa0é字x", max_size=40), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_fingerprints(rows):
    w = wd.words(wd.texts_of(pa.array(rows, pa.string())), lower=True)
    expected = [(t or "").encode().lower().split() for t in rows]
    assert [bytes(w.data[a:b]) for a, b in zip(w.starts, w.ends)] == [x for t in expected for x in t]
    assert np.diff(w.first).tolist() == [len(t) for t in expected]
    flat = [x for t in expected for x in t]
    assert len(set(w.hashes().tolist())) == len(set(flat))
    for n in (1, 2, 5):
        doc = w.doc
        assert wd.inside(w.first, n).tolist() == [doc[i] == doc[i + n - 1] for i in range(len(doc) - n + 1)]


def test_long_words_differ_far_behind():
    rows = ["x" * 5000, "x" * 4999 + "y", "x" * 4097 + "y" + "x" * 902]
    assert len(set(wd.words(wd.texts_of(pa.array(rows))).hashes().tolist())) == 3


def test_covered():
    flags = np.array([0, 1, 0, 0, 0, 0, 1], bool)
    assert wd.covered(flags, 3, 9).tolist() == [False, True, True, True, False, False, True, True, True]


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packed_numbers_come_back(values):
    values = np.array(sorted(values), np.uint64)
    assert pc.unpack(pc.pack(values)).tolist() == values.tolist()
    assert pc.unpack_sorted(pc.pack_sorted(values)).tolist() == values.tolist()
    whole = [v for _, part in pc.buckets(values, 3) for v in values[part].tolist()]
    assert whole == values.tolist()
