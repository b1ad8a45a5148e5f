"""The Merkle manifest against a plain version that hashes every node anew."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos string, digest string"
EXTRA = ("x", "y", "z")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def walk(tree, pos, digest):
    siblings = []
    for level in tree[:-1]:
        first = pos // 3 * 3
        run = level[first : first + 3]
        siblings += [d for i, d in enumerate(run) if first + i != pos]
        digest = h(*(digest if first + i == pos else d for i, d in enumerate(run)))
        pos //= 3
    return digest, siblings


def bent(row):
    return (*row[:4], row[4] and row[4].replace("\n", "")) if row[0] is not None and row[0] % 2 == 0 else row


def plain(rows):
    """What fold() should give, for rows whose even ids lose their line ends."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: levels([leaf(r) for r in own[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    for nth, s in enumerate(sources):
        for pos, r in enumerate(own[s]):
            digest, below = walk(trees[s], pos, leaf(bent(r)))
            digest, above = walk(top, nth, digest)
            yield r[0], leaf(r), trees[s][-1][0], root, h(*below, *above), digest, digest == root


def folded(spark, rows, **kwargs):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    text = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    changed = merkle.leaf_of(*(text if c == "text" else F.col(c) for c in merkle.FIELDS))
    return sorted(map(tuple, merkle.fold(merkle.build(docs, changed=changed, **kwargs), "changed").collect()), key=repr)


def rows_of(sizes, seed=1):
    rnd = random.Random(seed)
    rows = []
    for source, size in sizes.items():
        ids = rnd.sample(range(-5, 5 * size + 5), size)
        rows += [(i, source, rnd.choice(["en", None, "é"]), rnd.choice([None, i]), rnd.choice([None, "", "a\nb", "字\n" * 5])) for i in ids]
    return rows


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {None: 1, "a": 1, "": 1}, {"a": 100, "b": 1, None: 9, "é": 10, "z": 28, "": 2}, {f"s{i}": 1 + i % 3 for i in range(30)}],
)
def test_against_hashing_anew(spark, sizes):
    rows = rows_of(sizes)
    assert folded(spark, rows, levels=2) == sorted(plain(rows), key=repr)


def test_one_group_is_enough(spark):
    rows = rows_of({"a": 40, "b": 3})
    assert folded(spark, rows) == sorted(plain(rows), key=repr)


def test_repeated_rows_null_ids_and_long_texts(spark):
    rows = [(7, "a", "en", 1, "x\ny")] * 5 + [(7, "a", "en", 1, "other")] + [(None, "a", None, None, f"n\n{i}") for i in range(4)]
    rows += [(2, "a", "en", 9, "long\n" * 200_000), (4, "b", "en", 9, "\n")]
    assert folded(spark, rows, levels=1) == sorted(plain(rows), key=repr)


def test_no_documents(spark):
    assert folded(spark, []) == []


def test_states_resume_as_sha256_does():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(3)]
    for n in (1, 2, 3):
        state = merkle._START
        for d in digests[:n]:
            state = merkle.absorb(state, merkle._words(d))
        expected = hashlib.sha256(b"".join(d.hex().encode() for d in digests[:n])).digest()
        assert merkle._bytes(merkle.finish(state, np.array([n]))) == expected


def test_only_changed_leaves_fail(spark):
    rows = [(i, "a", "en", 1, "line\nline" if i % 4 == 0 else "line") for i in range(50)]
    assert {r[0] for r in folded(spark, rows, levels=2) if not r[-1]} == set(range(0, 50, 4))
