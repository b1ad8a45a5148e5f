import re
from collections import Counter

import numpy as np
import pyarrow as pa

from docspark.llm import quality
from docspark.llm import words as wd


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    twice, hit = Counter(runs), set()
    for k, run in enumerate(runs):
        if twice[run] > 1:
            hit.update(range(k, k + 5))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


TEXTS = [None, "", " \n\t", "a b c d e a b c d e", "x\nx\n x\n\nx", "#é* 字$ <a>|", "w " * 100_000, "a b c d e f g h i j k"]
TEXTS += ["one two three four five six seven eight nine ten", "p q r s t u p q r s t p q r s t\np q r s t"]


def test_counts_against_brute_force():
    counts, features = quality.statistics(wd.texts_of(pa.array(TEXTS, pa.string())))
    for i, text in enumerate(TEXTS):
        assert tuple(int(counts[k][i]) for k in counts) == brute(text), text
    assert np.isfinite(features).all()


def test_a_lone_row_is_isolated_first():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 1, (500, 2)), [[9.0, 9.0]]])
    forest = quality.fit(rows, (0, 1), trees=100, sample=256)
    scores = forest.scores(rows)
    assert scores.argmax() == 500 and scores[500] > 0.6 > np.median(scores)


def good(i):
    return " ".join(f"word{(i * 7 + k * k) % 97}" for k in range(40))


def test_verdicts(spark, docs_of):
    junk = [" ".join(f"w{i}{k}***" for k in range(30)) for i in range(40)]
    rows = [(i, good(i)) for i in range(200)] + [(1000 + i, t) for i, t in enumerate(junk)]
    rows += [(2000, None), (2001, ""), (2002, "a b"), (2003, "same " * 50), (None, good(3)), (5, good(5))]
    labels = [(i, 1, 0) for i in range(150)] + [(1000 + i, 0, 0) for i in range(30)] + [(None, 1, 0), (7, None, 0)]
    docs = docs_of(rows)
    rules = quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = Counter((r.doc_id, r.kept) for r in quality.judge(docs, rules).collect())
    assert sum(kept.values()) == len(rows)
    assert all(kept[i, True] for i in range(200)) and kept[5, True] == 2 and kept[None, True] == 1
    assert all(kept[1000 + i, False] for i in range(40))  # also those without a label
    assert all(kept[i, False] for i in (2000, 2001, 2002, 2003))
    stay = quality.keep(docs, rules)
    assert stay.columns == docs.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(i for (i, k), n in kept.items() if k for _ in range(n))


def test_without_labels_only_the_base_rule_counts(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, good(1)), (2, "***")])
    rules = quality.learn(docs, labels)
    assert {r.doc_id: r.kept for r in quality.judge(docs, rules).collect()} == {1: True, 2: False}
    assert quality.judge(docs_of([]), rules).collect() == []


def test_few_labels_switch_no_forest_off(spark, docs_of):
    junk = lambda i: " ".join(f"w{i}{k}***" for k in range(30))
    rows = [(i, good(i)) for i in range(97)] + [(1000 + i, junk(i)) for i in range(10)]
    labels = [(i, 1) for i in range(97)] + [(1000 + i, 0) for i in range(6)]
    docs = docs_of(rows)
    rules = quality.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = {r.doc_id: r.kept for r in quality.judge(docs, rules).collect()}
    assert all(kept[i] for i in range(97)) and not any(kept[1000 + i] for i in range(10))


def test_a_forest_stays_by_the_share_of_bad_rows():
    rng = np.random.default_rng(2)
    rows = np.zeros((700, 1))
    rows[:, 0] = rng.normal(0, 1, 700)
    rows[:3, 0] = [30, 31, 32]  # a rare kind of bad rows
    for times in (1, 10):  # the same verdict whatever the number of rows
        many = np.repeat(rows, times, axis=0)
        labels = np.arange(len(many)) >= 100 * times
        forest = quality.fit(many, (0,), trees=60, sample=256)
        rules = quality.calibrate([forest], many, labels, 0.0)
        assert rules.scores(many)[1][: 3 * times].all() and not rules.scores(many)[1][labels].any()
