"""Quality rules: an isolation forest over rule statistics of every document.

A document's statistics are ratios that do not depend on its length.  Isolation trees cut
the space of statistics at random places; a document that few cuts set apart is anomalous.
One forest sees all statistics together and one more sees each statistic alone, because
random cuts over many statistics dilute what a single one shows.  All are fitted on a bounded
sample of labelled rows; the score from which a forest rejects a document is the lowest one
with which all forests together wrongly reject at most ``max_false`` of the good rows.

Defined results: a null text has no words; a document with few words or many repeated words
fails the base rule and is rejected whatever the forest says; without good and bad labelled
rows the forest rejects nothing; labels with a null id or a null verdict are left out;
repeated rows are judged alike, each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docspark.llm import words as wd

# Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

# How many times as often a forest must reject bad labelled rows as good ones.
MIN_BAD = 9

FEATURES = ("symbols", "shouted", "exclaimed", "bare", "stuttered", "repeated", "dup_lines")

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LOWER = np.isin(np.arange(256), np.arange(97, 123))
_LETTER = _UPPER | _LOWER | (np.arange(256) >= 128)
_BANG = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_HEAD = (np.arange(256) & 0xC0) != 0x80  # first bytes of UTF-8 characters

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts of the base rule, and the statistics that the forest sees, of each text."""
    w = wd.words(texts)
    n = np.diff(w.first)
    by_byte = lambda flag: wd.per_doc(w.offsets, flag[w.data])
    counts = {
        "n_words": n,
        "word_chars": by_byte(_HEAD & ~wd.SPACE),
        "n_symbols": by_byte(_SYMBOL),
        "n_dup_lines": np.zeros(len(n), np.int64),
    }
    n_lines = np.zeros(len(n), np.int64)
    for i, text in enumerate(texts.to_pylist()):
        lines = [line for line in text.split(b"\n") if not line.isspace() and line]
        n_lines[i] = len(lines)
        counts["n_dup_lines"][i] = len(lines) - len(set(lines))
    h = w.hashes()
    doc = w.doc
    window = wd.grams(h, WINDOW) ^ wd.mix(doc[: max(0, len(h) - WINDOW + 1)].astype(np.uint64))
    twice = np.zeros(len(window), bool)
    real = wd.inside(w.first, WINDOW)
    twice[real] = pd.Series(window[real]).duplicated(keep=False).to_numpy()
    counts["n_repeat_words"] = wd.per_doc(w.first, wd.covered(twice, WINDOW, len(h)))

    any_in = lambda flag: _sums(flag[w.data], w)
    upper, lower, letters = any_in(_UPPER), any_in(_LOWER), any_in(_LETTER)
    again = np.zeros(len(h), bool)
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    share = lambda flag: wd.per_doc(w.first, flag) / np.maximum(n, 1)
    features = np.column_stack(
        [
            counts["n_symbols"] / np.maximum(n, 1),
            share((upper >= 2) & (lower == 0)),
            by_byte(_BANG) / np.maximum(n, 1),
            share(letters == 0),
            share(again),
            counts["n_repeat_words"] / np.maximum(n, 1),
            counts["n_dup_lines"] / np.maximum(n_lines, 1),
        ]
    )
    return counts, features


def _sums(flags: np.ndarray, w: wd.Words) -> np.ndarray:
    """Flagged bytes of each word."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[w.ends] - total[w.starts]


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * n)


@dataclass
class Forest:
    """Isolation trees as flat arrays; node 0 is a tree's root, leaves have feature -1."""

    feature: np.ndarray  # (trees, nodes)
    cut: np.ndarray
    child: np.ndarray  # the left child; the right one follows it
    depth: np.ndarray  # path length where a row ends
    usual: float  # path length of a row nobody would call odd
    levels: int
    columns: tuple[int, ...]  # the statistics that it sees
    threshold: float = float("inf")

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; rows that few cuts set apart score high."""
        rows = rows[:, self.columns]
        total = np.zeros(len(rows))
        at_row = np.arange(len(rows))
        for feature, cut, child, depth in zip(self.feature, self.cut, self.child, self.depth):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.levels):
                f = feature[node]
                right = rows[at_row, np.maximum(f, 0)] >= cut[node]
                node = np.where(f < 0, node, child[node] + right)
            total += depth[node]
        return np.exp2(-total / (len(self.feature) * self.usual))


@dataclass
class Rules:
    """Calibrated forests; a document that any of them rejects is anomalous."""

    forests: list[Forest]

    def scores(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest anomaly score of each row, and whether a forest rejects it."""
        worst, odd = np.zeros(len(rows)), np.zeros(len(rows), bool)
        for forest in self.forests:
            scores = forest.scores(rows)
            worst = np.maximum(worst, scores)
            odd |= scores > forest.threshold
        return worst, odd


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary search tree of n rows."""
    if n < 2:
        return 0.0
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def fit(rows: np.ndarray, columns: tuple[int, ...], trees: int, sample: int, seed: int = 7) -> Forest:
    """Grow the trees, each on its own random rows."""
    rows = rows[:, columns]
    rng = np.random.default_rng(seed)
    sample = min(sample, len(rows))
    levels = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    grown = [_tree(rows[rng.choice(len(rows), sample, replace=False)], levels, rng) for _ in range(trees)]
    size = max(len(t) for t in grown)
    flat = np.full((4, trees, size), -1.0)
    for i, tree in enumerate(grown):
        flat[:, i, : len(tree)] = np.array(tree).T
    return Forest(
        flat[0].astype(np.int64),
        flat[1],
        flat[2].astype(np.int64),
        flat[3],
        max(usual_path(sample), 1e-9),
        levels,
        columns,
    )


def _tree(rows: np.ndarray, levels: int, rng: np.random.Generator) -> list[tuple]:
    nodes: list[tuple] = [()]
    work = [(0, rows, 0)]
    while work:
        at, own, depth = work.pop()
        low, high = own.min(axis=0), own.max(axis=0)
        open_features = np.flatnonzero(low < high)
        if depth >= levels or not len(open_features):
            nodes[at] = (-1, 0.0, -1, depth + usual_path(len(own)))
            continue
        f = rng.choice(open_features)
        cut = rng.uniform(low[f], high[f])
        cut = cut if cut > low[f] else high[f]
        nodes[at] = (f, cut, len(nodes), 0.0)
        left = own[:, f] < cut
        work += [(len(nodes), own[left], depth + 1), (len(nodes) + 1, own[~left], depth + 1)]
        nodes += [(), ()]
    return nodes


def calibrate(forests: list[Forest], rows: np.ndarray, good: np.ndarray, max_false: float) -> Rules:
    """Set the lowest thresholds that reject at most ``max_false`` of the good rows.

    A forest is left out if it rejects less than ``MIN_BAD`` times the share of the bad rows
    that it rejects of the good ones: what it calls odd is then not what the labels call bad.
    Shares are alike at every number of labels, and one bad row is enough if no good one goes.
    """
    if not good.any() or good.all():
        return Rules([])
    spare = int(max_false / len(forests) * good.sum())
    for forest in forests:
        scores = forest.scores(rows)
        forest.threshold = float(np.sort(scores[good])[good.sum() - 1 - spare])
        odd = scores > forest.threshold
        if not odd[~good].any() or odd[~good].mean() < MIN_BAD * odd[good].mean():
            forest.threshold = float("inf")
    return Rules(forests)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    max_false: float = 0.005,
    trees: int = 60,
    sample: int = 256,
) -> Rules | None:
    """Fit and calibrate on at most ``max_rows`` labelled documents.

    The rows are those whose ids come first in hash order, so the sample does not depend on
    the layout; it is the only data that reaches the driver.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("_good"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("_good", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            for i, j in wd.slices(texts):
                counts, features = statistics(texts.slice(i, j - i))
                data = {"good": batch.column("_good").slice(i, j - i), "failed": pa.array(base_failed(counts))}
                data |= {name: pa.array(features[:, k]) for k, name in enumerate(FEATURES)}
                yield pa.RecordBatch.from_pydict(data)

    schema = "good int, failed boolean, " + ", ".join(f"{name} double" for name in FEATURES)
    seen = rows.withColumn("_good", F.col("_good").cast("int")).mapInArrow(measure, schema)
    # A repeated id could bring more rows than there are labels.
    seen = seen.orderBy(*FEATURES, "good").limit(max_rows).toPandas()
    seen = seen[~seen["failed"]]
    if not len(seen):
        return None
    values = seen[list(FEATURES)].to_numpy()
    alone = [(k,) for k in range(len(FEATURES))]
    forests = [fit(values, columns, trees, sample) for columns in [tuple(range(len(FEATURES))), *alone]]
    return calibrate(forests, values, seen["good"].to_numpy() == 1, max_false)


def judge(docs: DataFrame, rules: Rules | None) -> DataFrame:
    """Counts, base verdict, anomaly score and final verdict of every document."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {STATS}, base_failed boolean, kept boolean, anomaly double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            for i, j in wd.slices(texts):
                counts, features = statistics(texts.slice(i, j - i))
                failed = base_failed(counts)
                scores, odd = rules.scores(features) if rules else (np.zeros(j - i), np.zeros(j - i, bool))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id").slice(i, j - i)}
                    | {k: pa.array(counts[k], pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
                    | {"base_failed": pa.array(failed), "kept": pa.array(~failed & ~odd), "anomaly": pa.array(scores)}
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep(docs: DataFrame, rules: Rules | None, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column(text))
            for i, j in wd.slices(texts):
                counts, features = statistics(texts.slice(i, j - i))
                bad = base_failed(counts)
                if rules:
                    bad |= rules.scores(features)[1]
                yield batch.slice(i, j - i).filter(pa.array(~bad))

    return docs.mapInArrow(run, docs.schema)
