import random

import pytest

from docspark.llm import substrings


def brute(rows, window):
    """Kept words of each row: a window goes if a smaller document holds it too."""
    order = lambda i: float("inf") if i is None else i
    smallest = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            smallest[run] = min(smallest.get(run, order(i)), order(i))
    found = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if smallest[tuple(words[k : k + window])] < order(i):
                gone[k : k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        found.append((i, len(words), sum(gone), kept))
    return sorted(found, key=str)


@pytest.mark.parametrize("piece_bytes", [8_000_000, 300])
def test_against_brute_force(spark, docs_of, monkeypatch, piece_bytes):
    monkeypatch.setattr("docspark.llm.pieces.PIECE_BYTES", piece_bytes)
    monkeypatch.setattr("docspark.llm.pieces.BUCKET_BYTES", max(1000, piece_bytes // 4))
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    passages = [" ".join(word() for _ in range(rng.randint(4, 20))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(9)) for _ in range(5)]
        rows.append((rng.randint(0, 45), rng.choice(["\n", " ", "\t "]).join(parts)))
    rows += [(200, None), (201, ""), (202, "a"), (None, rows[0][1]), (None, rows[1][1]), (203, "x " * 50_000)]
    rows.append((1, rows[0][1]))
    found = [tuple(r) for r in substrings.remove_repeats(docs_of(rows), window=5).collect()]
    assert sorted(found, key=str) == brute(rows, 5)


def test_no_documents(spark, docs_of):
    assert substrings.remove_repeats(docs_of([])).collect() == []
