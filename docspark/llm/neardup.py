"""MinHash near-duplicates with tensored banding.

A document is the set of its word shingles.  Two collections of ``tables`` keys, each key
made of ``rows`` minhashes, are computed once; a table of the index is a pair of one key from
each collection, so 2 x tables x rows minhashes serve tables^2 tables.  Documents that share
a table are candidates, and every link is confirmed on the full sets.

Exact copies of a set form one class first, so a group of copies counts once.  Within a table
every class is held against the smallest class only.  Candidates that this leaves in
different components are then compared in blocks inside the tasks, most similar first, which
return links only.  So no pairs of a group are emitted that cannot change the result.

With the defaults a link of similarity exactly 0.8 is missed with probability 4e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docspark.llm import words as wd
from docspark.llm.components import components
from docspark.sources import staging

TABLES = 16
ROWS = 3
# Members of one block of a large group; blocks are compared pair by pair.
BLOCK = 2_000
BLOCK_BYTES = 8_000_000
# Unpacked text that a task holds while it confirms links.
CONFIRM_BYTES = 4_000_000
# A pair whose estimated similarity lies this many standard errors below the bound is no link.
SIGMAS = 4.5

_rng = np.random.Generator(np.random.PCG64(99))
_FACTORS = _rng.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(w: wd.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of the distinct shingles of all documents, by document.

    Returns the fingerprints, where each document's begin, and their numbers.  A document of
    fewer words has one shingle, the whole sequence; a document without words has none.
    """
    h = w.hashes()
    sizes = np.diff(w.first)
    doc = w.doc
    runs = wd.grams(h, size)
    real = wd.inside(w.first, size)
    found, owner = runs[real], doc[: len(runs)][real]
    for k in range(1, size):
        short = np.flatnonzero(sizes == k)
        if len(short):
            found = np.concatenate([found, wd.mix(wd.grams(h, k)[w.first[short]] + np.uint64(k))])
            owner = np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    found, owner = found[order], owner[order]
    again = pd.Series(found ^ wd.mix(owner.astype(np.uint64) + np.uint64(1))).duplicated().to_numpy()
    found, owner = found[~again], owner[~again]
    counts = np.bincount(owner, minlength=len(sizes))
    return found, np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64), counts


def _sketch(texts: pa.Array, size: int, tables: int, rows: int) -> dict[str, pa.Array]:
    found, begin, counts = shingles(wd.words(texts, lower=True), size)
    full = counts > 0
    n, hashes = len(counts), 2 * tables * rows
    low = np.zeros((n, hashes), np.uint64)
    if full.any():
        for k in range(hashes):
            low[full, k] = np.minimum.reduceat(found * _FACTORS[k], begin[full])
    total = np.zeros((n, 2), np.uint64)
    if full.any():
        total[full, 0] = np.add.reduceat(wd.mix(found), begin[full])
        total[full, 1] = np.add.reduceat(wd.mix(found + np.uint64(0x9E37)), begin[full])
    total[:, 1] ^= wd.mix(counts.astype(np.uint64))
    keys = np.zeros((n, 2 * tables), np.uint64)
    for t in range(2 * tables):
        keys[:, t] = t + 1
        for r in range(rows):
            keys[:, t] = wd.mix(keys[:, t] * np.uint64(31) + low[:, t * rows + r])
    each = pa.array(np.arange(0, (n + 1) * tables, tables, dtype=np.int32))
    listed = lambda part: pa.ListArray.from_arrays(each, pa.array(part.reshape(-1).view(np.int64)))
    fixed = lambda part, width: pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(part))]).cast(pa.binary())
    return {
        "n_shingles": pa.array(counts, pa.int64()),
        "cls": fixed(total.byteswap(), 16),
        "a": listed(keys[:, :tables]),
        "b": listed(keys[:, tables:]),
        "signature": fixed((low >> np.uint64(40)).astype(np.uint8), hashes),
    }


def sketches(docs: DataFrame, size: int, tables: int = TABLES, rows: int = ROWS) -> DataFrame:
    """Class, table keys and signature of every document (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            for i, j in wd.slices(texts):
                made = _sketch(texts.slice(i, j - i), size, tables, rows)
                own = {c: batch.column(c).slice(i, j - i) for c in ("doc_id", "text_hash")}
                yield pa.RecordBatch.from_pydict(own | made)

    schema = "doc_id long, text_hash long, n_shingles long, cls binary, a array<long>, b array<long>, signature binary"
    return docs.select(F.col("doc_id").cast("long"), "text", _text_hash()).mapInArrow(run, schema)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def cluster(docs: DataFrame, size: int = 5, percent: int = 80, tables: int = TABLES, rows: int = ROWS) -> DataFrame:
    """The component of every document under links of at least ``percent`` similarity.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read.  The result has one row
    per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id that
    links reach), ``kept`` (whether it is that smallest one) and ``text_hash``.

    Defined results: a null or blank text has an empty set, is linked with nothing and is
    kept; equal texts are linked whatever their length; a row with a null id takes part in
    linking and is never the smallest, unless its component has only null ids, which then
    have a null component and are kept; rows that repeat a doc_id with the same text share
    their verdict.  ``text_hash`` tells apart rows that repeat a doc_id with another text.
    """
    sketch, _ = staging.stage(sketches(docs, size, tables, rows), "sketches")
    classes = sketch.where("n_shingles > 0").groupBy("cls")
    classes = classes.agg(
        F.min("doc_id").alias("rep_id"), *[F.first(c).alias(c) for c in ("a", "b", "signature")]
    )
    classes, _ = staging.stage(classes, "classes")

    # A class that shares no key of the first collection shares no table.
    keyed = classes.select("cls", F.explode("a").alias("akey"))
    shared = keyed.groupBy("akey").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members, _ = staging.stage(keyed.join(shared, "akey"), "members")

    pairs, _ = staging.stage(_stars(members, classes), "stars")
    involved = pairs.select("cls").union(pairs.select(F.col("other").alias("cls"))).distinct()
    packed, _ = staging.stage(_packed(docs, classes, involved, size), "packed")

    hashes = 2 * tables * rows
    bound = percent / 100
    least = int(hashes * (bound - SIGMAS * np.sqrt(bound * (1 - bound) / hashes)))
    links = _confirmed(_similar(pairs, classes, least), packed, size, percent)
    links, _ = staging.stage(links, "confirmed")
    label = components(links)
    more, n = staging.stage(_across(members, classes, packed, label, least, size, percent), "across")
    if n:
        label = components(links.union(more))

    part = classes.select("cls", "rep_id").join(label.withColumnRenamed("node", "cls"), "cls", "left")
    part = part.select("cls", "rep_id", F.coalesce("label", "cls").alias("label"))
    smallest = part.groupBy("label").agg(F.min("rep_id").alias("component_id"))
    part = part.join(smallest, "label").select("cls", "component_id")
    empty = F.col("n_shingles") == 0
    return (
        sketch.select("doc_id", "text_hash", "n_shingles", "cls")
        .join(part, "cls", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80, tables: int = TABLES, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each group.

    Rows without words all stay.  Of rows that repeat a doc_id and a text, one stays.
    """
    verdict = cluster(docs, size, percent, tables, rows).where("kept")
    verdict = verdict.groupBy(F.struct("doc_id", "text_hash").alias("of")).agg(F.max("n_shingles").alias("n"))
    whole = docs.select(
        F.struct(*docs.columns).alias("row"), F.struct(F.col("doc_id").cast("long"), _text_hash()).alias("own")
    )
    order = Window.partitionBy("of").orderBy("row.text")
    staying = whole.join(verdict, F.col("own").eqNullSafe(F.col("of"))).withColumn("nth", F.row_number().over(order))
    return staying.where("nth = 1 OR n = 0").select("row.*")


def _stars(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Every class of a table with the smallest class of that table."""
    filed = members.select("akey", "cls").join(classes.select("cls", F.explode("b").alias("bkey")), "cls")
    filed = filed.select("cls", F.xxhash64("akey", "bkey").alias("table"))
    centers = filed.groupBy("table").agg(F.min("cls").alias("other"), F.max("cls").alias("last"))
    centers = centers.where("other <> last").select("table", "other")
    return filed.join(centers, "table").where("cls <> other").select("cls", "other").distinct()


def _packed(docs: DataFrame, classes: DataFrame, involved: DataFrame, size: int) -> DataFrame:
    """The compressed text of one document of each class that has candidates."""
    wanted = classes.select("cls", "rep_id").join(involved, "cls", "left_semi")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            packed = [
                len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts.to_pylist()
            ]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "packed": pa.array(packed, pa.binary())})

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("packed").to_pylist()
            right = []
            for cls, p in zip(batch.column("cls").to_pylist(), own):
                made = _sketch(pa.array([_unpack(p)], pa.large_binary()), size, 1, 1)
                right.append(made["cls"][0].as_py() == cls)
            yield batch.filter(pa.array(right, pa.bool_()))

    small = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, "doc_id long, packed binary")
    found = small.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("cls", "packed")
    # A repeated doc_id may bring a text of another class.
    return found.mapInArrow(named, found.schema).groupBy("cls").agg(F.first("packed").alias("packed"))


def _unpack(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def _similar(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs whose signatures agree in ``least`` places or more."""
    own = classes.select("cls", F.col("signature").alias("s1"))
    theirs = classes.select(F.col("cls").alias("other"), F.col("signature").alias("s2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s1, s2 = (_matrix(batch.column(c)) for c in ("s1", "s2"))
                yield batch.filter(pa.array((s1 == s2).sum(axis=1) >= least)).select(["cls", "other"])

    return pairs.join(own, "cls").join(theirs, "other").mapInArrow(run, "cls binary, other binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _confirmed(pairs: DataFrame, packed: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    own = packed.select("cls", F.col("packed").alias("p1"))
    theirs = packed.select(F.col("cls").alias("other"), F.col("packed").alias("p2"))
    both = pairs.join(own, "cls").join(theirs, "other").select("cls", "other", "p1", "p2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1s, p2s = batch.column("p1"), batch.column("p2")
            at = 0
            while at < batch.num_rows:
                # Texts of a stretch of rows, each once, as long as they are not too many bytes.
                place: dict[bytes, int] = {}
                held, ends = 0, []
                while at + len(ends) < batch.num_rows and held < CONFIRM_BYTES:
                    row = []
                    for p in (p1s[at + len(ends)].as_py(), p2s[at + len(ends)].as_py()):
                        if p not in place:
                            place[p] = len(place)
                            held += int.from_bytes(p[:8], "little")
                        row.append(place[p])
                    ends.append(row)
                sets = _sets(pa.array(list(place), pa.binary()), np.arange(len(place)), size)
                good = [_linked(sets[x], sets[y], percent) for x, y in ends]
                kept = batch.slice(at, len(ends)).filter(pa.array(good, pa.bool_()))
                yield pa.RecordBatch.from_pydict({"u": kept.column("cls"), "v": kept.column("other")})
                at += len(ends)

    return both.mapInArrow(run, "u binary, v binary")


def _across(
    members: DataFrame, classes: DataFrame, packed: DataFrame, label: DataFrame, least: int, size: int, percent: int
) -> DataFrame:
    """Links (u, v) between components, enough of them to connect all that are linked.

    Classes that share a key and lie in different components are cut in blocks by number and
    bytes.  A task holds two blocks, compares their signatures, and confirms the pairs that
    may be links on the full sets, except those that links found before already connect.
    """
    placed = members.join(packed, "cls").join(label.withColumnRenamed("node", "cls"), "cls", "left")
    placed = placed.withColumn("label", F.coalesce("label", "cls"))
    groups = placed.groupBy("akey").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("packed")).alias("bytes"),
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int")
    groups = groups.where("low <> high").select("akey", blocks.alias("blocks"))
    rows = placed.join(groups, "akey").join(classes.select("cls", "a", "signature"), "cls")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "akey", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"),
        "own", "cls", "label", "a", "signature", "packed",
    )
    rows = rows.repartition("akey", "x", "y").sortWithinPartitions("akey", "x", "y", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["akey", "x", "y"]):
            left, right = _settle(group, least, size, percent)
            cls = group.column("cls")
            yield pa.RecordBatch.from_pydict({"u": cls.take(pa.array(left)), "v": cls.take(pa.array(right))})

    return rows.mapInArrow(run, "u binary, v binary").distinct()


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys together, from sorted batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0]
        change = np.zeros(whole.num_rows, bool)
        for key in keys:
            values = whole.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(edges, edges[1:]):
            yield whole.slice(a, b - a)
        rest = [whole.slice(edges[-1])]
    yield from rest


def _settle(group: pa.RecordBatch, least: int, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of confirmed links that connect different components."""
    label = pd.factorize(group.column("label").to_pandas())[0]
    none = np.zeros(0, np.int64)
    if (label == label[0]).all():
        return none, none
    n, own = len(label), group.column("own").to_numpy()
    one_block = group.column("x")[0].as_py() == group.column("y")[0].as_py()
    signature = _matrix(group.column("signature"))
    keys = group.column("a").flatten().to_numpy().reshape(n, -1)
    key = group.column("akey")[0].as_py()
    found = []
    step = max(1, 8_000_000 // (n * signature.shape[1]))
    for i in range(0, n, step):
        agree = (signature[i : i + step, None, :] == signature[None, :, :]).sum(axis=2, dtype=np.int16)
        agree[label[i : i + step, None] == label[None, :]] = 0
        if not one_block:  # pairs of one block belong to that block alone
            agree[own[i : i + step, None] == own[None, :]] = 0
        x, y = np.nonzero(agree >= least)
        agree, x = agree[x, y], x + i
        same = keys[x] == keys[y]
        # A pair that shares more keys belongs to the group of the first.
        mine = (x < y) & (keys[x, same.argmax(axis=1)] == key)
        found.append(np.column_stack([agree[mine], x[mine], y[mine]]))
    pairs = np.concatenate(found)
    if not len(pairs):
        return none, none
    pairs = pairs[np.argsort(-pairs[:, 0], kind="stable")]
    sets = _sets(group.column("packed"), np.unique(pairs[:, 1:]), size)
    top = list(range(int(label.max()) + 1))

    def root(at: int) -> int:
        while top[at] != at:
            top[at] = top[top[at]]
            at = top[at]
        return at

    links = []
    for _, x, y in pairs.tolist():
        p, q = root(label[x]), root(label[y])
        if p != q and _linked(sets[x], sets[y], percent):
            top[p] = q
            links.append((x, y))
    return tuple(np.array(links, np.int64).reshape(-1, 2).T)


def _sets(packed: pa.Array, rows: np.ndarray, size: int) -> dict[int, np.ndarray]:
    """The sorted shingle set of each of these rows."""
    sets, texts, held = {}, [], 0
    for i, row in enumerate(rows.tolist()):
        texts.append((row, _unpack(packed[row].as_py())))
        held += len(texts[-1][1])
        if held < CONFIRM_BYTES and i + 1 < len(rows):
            continue
        column = pa.array([t for _, t in texts], pa.large_binary())
        found, begin, counts = shingles(wd.words(column, lower=True), size)
        for (own, _), a, n in zip(texts, begin.tolist(), counts.tolist()):
            sets[own] = np.sort(found[a : a + n])
        texts, held = [], 0
    return sets


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = int(np.count_nonzero(b[at] == a))
    return 100 * same >= percent * (len(a) + len(b) - same)
