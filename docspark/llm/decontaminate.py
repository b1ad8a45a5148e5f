"""Benchmark decontamination: SimHash windows, multi-index Hamming search, exact check.

A window has as many words as the benchmark item that it is held against.  Its SimHash is
built from its word shingles, each weighing as often as it occurs.  The fingerprints of the
items are indexed by blocks: two fingerprints within the radius agree in some block up to one
bit, so looking up every block and its one-bit neighbours finds all items within the radius.
What is found is verified by the exact weighted similarity of the shingles (sum of minima
over sum of maxima).

A window that is similar enough shares most shingles with the item, so only windows that hold
enough of an item's shingles are built, wherever these stand; no window that could pass is left
out.  Fingerprints of a pair near the bound may lie beyond the radius, so a window is verified
against the items that it was built for as well, and no such pair is lost.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; an item of fewer
words than a shingle is found where its words stand in a document in a row; null texts and
null items have no words and match nothing; equal items are each reported; rows that repeat a
doc_id are reported once for each item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docspark.llm import words as wd

# Items of one pass over the documents.
ITEM_BLOCK = 20_000
# Windows whose fingerprints a task makes at a time.
WINDOW_BLOCK = 1_024
# Places shared with items that a task sorts at a time, unless one document has more.
SHARED_BLOCK = 1_000_000
BITS = 64
BLOCKS = 8
# Blocks match up to one bit, so the index finds every pair within this distance.
RADIUS = 2 * BLOCKS - 1
_ONE_BIT = np.array([0, *(1 << np.arange(BITS // BLOCKS))], np.uint8)


def simhash(shingles: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """SimHash of each of ``count`` weighted sets; a shingle weighs as often as it comes."""
    order = np.argsort(owner, kind="stable")
    bits = np.unpackbits(shingles[order].view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    total = np.zeros((count, BITS), np.int64)
    present, begin = np.unique(owner[order], return_index=True)
    if len(begin):
        total[present] = np.add.reduceat(bits, begin, axis=0)
    return np.packbits(total > 0, axis=1).reshape(count, BITS // 8)


class Items:
    """The items of one pass: their shingles and the index of their fingerprints."""

    def __init__(self, rows: list[tuple[int, str]], size: int) -> None:
        self.size = size
        texts = pa.array([t.encode() for _, t in rows], pa.large_binary())
        w = wd.words(texts, lower=True)
        h = w.hashes()
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.words = np.diff(w.first)
        # The shingles of an item, in order.
        self.shingles = []
        runs = wd.grams(h, size)
        for i, n in enumerate(self.words.tolist()):
            at = int(w.first[i])
            self.shingles.append(runs[at : at + n - size + 1] if n >= size else wd.grams(h[at : at + n], n)[:1])
        # Items shorter than a shingle, by their words and the fingerprint of the whole.
        self.short: dict[int, dict[int, list[int]]] = {}
        for i in np.flatnonzero((self.words > 0) & (self.words < size)).tolist():
            self.short.setdefault(int(self.words[i]), {}).setdefault(int(self.shingles[i][0]), []).append(i)
        self.known = [dict(zip(*(x.tolist() for x in np.unique(s, return_counts=True)))) for s in self.shingles]
        counts = [len(s) for s in self.shingles]
        flat = np.concatenate([np.zeros(0, np.uint64), *self.shingles])
        owner = np.repeat(np.arange(len(rows)), counts)
        self.prints = simhash(flat, owner, len(rows))
        # Where a shingle stands: (item, place), by shingle.
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(c) for c in counts]])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner, self.place = flat[order], owner[order], place[order]
        self.may = np.zeros(1 << 20, bool)
        self.may[(flat & np.uint64(0xFFFFF)).astype(np.int64)] = True
        self.index: list[dict[int, np.ndarray]] = []
        for block in range(BLOCKS):
            values = self.prints[:, block]
            self.index.append({int(v): np.flatnonzero(values == v) for v in np.unique(values)})

    def within(self, fingerprint: np.ndarray) -> set[int]:
        """All items whose fingerprints lie within the radius."""
        found: set[int] = set()
        for block, values in enumerate(self.index):
            for value in (fingerprint[block] ^ _ONE_BIT).tolist():
                if value in values:
                    found.update(values[value].tolist())
        near = np.fromiter(found, np.int64, len(found))
        distance = np.unpackbits(self.prints[near] ^ fingerprint, axis=1).sum(axis=1)
        return set(near[distance <= RADIUS].tolist())

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted similarity of the shingles of an item and of a window."""
        known = self.known[item]
        values, counts = np.unique(window, return_counts=True)
        least = sum(min(known.get(v, 0), c) for v, c in zip(values.tolist(), counts.tolist()))
        return least / (len(window) + len(self.shingles[item]) - least)


def _matches(items: Items, texts: pa.Array, bound: float) -> Iterator[tuple[int, int, int, int, float]]:
    """(document, item, first word, words, similarity) of the best window for each item."""
    w = wd.words(texts, lower=True)
    h = w.hashes()
    runs = wd.grams(h, items.size)
    real = wd.inside(w.first, items.size)
    doc = w.doc
    at = np.flatnonzero(real & items.may[(runs & np.uint64(0xFFFFF)).astype(np.int64)])
    left = np.searchsorted(items.flat, runs[at], "left")
    right = np.searchsorted(items.flat, runs[at], "right")
    at, left, right = at[right > left], left[right > left], right[right > left]
    windows: dict[tuple[int, int, int], set[int]] = {}
    for d, item, places in _shared(doc[at], at, left, right, items):
        begin, end = int(w.first[d]), int(w.first[d + 1])
        # A document shorter than the item is one window.
        n = min(int(items.words[item]), end - begin)
        span = n - items.size + 1
        # The fewest shared shingles with which the similarity can reach the bound.
        need = max(1, int(np.ceil(bound * (span + len(items.shingles[item])) / (1 + bound) - 1e-9)))
        low = places[need - 1 :] - span + 1
        high = places[: len(low)]
        done = begin
        for lo, hi in zip(low[low <= high].tolist(), high[low <= high].tolist()):
            for first in range(max(done, lo), min(hi, end - n) + 1):
                windows.setdefault((d, first, n), set()).add(item)
                done = first + 1
    best: dict[tuple[int, int], tuple[int, int, float]] = {}
    ordered = sorted(windows)
    for lo in range(0, len(ordered), WINDOW_BLOCK):
        part = ordered[lo : lo + WINDOW_BLOCK]
        sets = [runs[first : first + n - items.size + 1] for _, first, n in part]
        owner = np.repeat(np.arange(len(part)), [len(s) for s in sets])
        prints = simhash(np.concatenate(sets), owner, len(part))
        for (d, first, n), own, fingerprint in zip(part, sets, prints):
            for item in items.within(fingerprint) | windows[d, first, n]:
                score = items.similarity(item, own)
                if score >= bound and score > best.get((d, item), (0, 0, 0.0))[2]:
                    best[d, item] = (first - int(w.first[d]), n, score)
    for (d, item), (first, n, score) in best.items():
        yield d, item, first, n, score
    yield from _verbatim(items, h, w.first, doc)


def _shared(
    doc: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, items: Items
) -> Iterator[tuple[int, int, np.ndarray]]:
    """(document, item, places in ascending order) of the shingles that they share."""
    count = right - left
    # Whole documents together, as many as share about so many places with items.
    part = (np.cumsum(count) - count) // SHARED_BLOCK
    part = part[np.searchsorted(doc, doc)]
    for lo, hi in _runs_of(part):
        n = count[lo:hi]
        entry = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left[lo:hi], n)
        rows = np.stack([np.repeat(doc[lo:hi], n), items.owner[entry], np.repeat(at[lo:hi], n)])
        rows = rows[:, np.lexsort(rows[::-1])]
        # An item may hold a shingle more than once.
        rows = rows[:, (np.diff(rows, axis=1, prepend=-1) != 0).any(axis=0)]
        for a, b in _runs_of(rows[:2]):
            yield int(rows[0, a]), int(rows[1, a]), rows[2, a:b]


def _runs_of(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of equal columns."""
    edges = np.flatnonzero((np.diff(np.atleast_2d(keys), axis=1, prepend=-1, append=-1) != 0).any(axis=0)).tolist()
    return zip(edges, edges[1:])


def _verbatim(
    items: Items, h: np.ndarray, first: np.ndarray, doc: np.ndarray
) -> Iterator[tuple[int, int, int, int, float]]:
    """The first place in each document of every item that is shorter than a shingle."""
    for n, short in items.short.items():
        runs = wd.grams(h, n)
        places = np.flatnonzero(wd.inside(first, n) & np.isin(runs, np.fromiter(short, np.uint64, len(short))))
        seen: set[tuple[int, int]] = set()
        for place, d, run in zip(places.tolist(), doc[places].tolist(), runs[places].tolist()):
            if (d, run) not in seen:
                seen.add((d, run))
                for item in short[run]:
                    yield d, item, place - int(first[d]), n, 1.0


def find(docs: DataFrame, benchmark: DataFrame, size: int = 5, bound: float = 0.8) -> DataFrame:
    """The items that documents contain, one row for each pair of them.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.  The result has doc_id,
    item_id, first_word, n_words and similarity of the best window.  The benchmark is read in
    blocks of bounded size, each held against all documents in one pass.
    """
    schema = "doc_id long, item_id long, first_word long, n_words long, similarity double"
    found = None
    for items in _blocks(benchmark, size):
        hits = _one_pass(docs, items, bound, schema)
        found = hits if found is None else found.union(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    # Repeated rows of a document report an item once.
    best = F.max(F.struct("similarity", -F.col("first_word"), "n_words")).alias("best")
    best_of = found.groupBy("doc_id", "item_id").agg(best)
    return best_of.select(
        "doc_id",
        "item_id",
        (-F.col("best.col2")).alias("first_word"),
        F.col("best.n_words").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, size: int = 5, bound: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no item."""
    for items in _blocks(benchmark, size):
        docs = docs.mapInArrow(_clean_rows(docs.sparkSession.sparkContext.broadcast(items), bound), docs.schema)
    return docs


def _clean_rows(shipped, bound: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            for i, j in wd.slices(texts):
                clean = np.ones(j - i, bool)
                clean[[hit[0] for hit in _matches(shipped.value, texts.slice(i, j - i), bound)]] = False
                yield batch.slice(i, j - i).filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame, size: int) -> Iterator[Items]:
    """The items, some at a time."""
    block: list[tuple[int, str]] = []
    for row in benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").toLocalIterator():
        if row.text.encode().split():
            block.append((row.item_id, row.text))
        if len(block) == ITEM_BLOCK:
            yield Items(block, size)
            block = []
    if block:
        yield Items(block, size)


def _one_pass(docs: DataFrame, items: Items, bound: float, schema: str) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in wd.slices(texts):
                hits = list(_matches(shipped.value, texts.slice(i, j - i), bound))
                columns = list(zip(*hits)) or [[]] * 5
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids.slice(i, j - i).take(pa.array(columns[0], pa.int64())),
                        "item_id": pa.array(shipped.value.ids[np.array(columns[1], np.int64)]),
                        "first_word": pa.array(columns[2], pa.int64()),
                        "n_words": pa.array(columns[3], pa.int64()),
                        "similarity": pa.array(columns[4], pa.float64()),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
