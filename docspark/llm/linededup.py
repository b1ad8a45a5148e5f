"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

The state is a table of line keys with the number of documents that hold each.  Inserting or
deleting documents adds or takes away their references, so a document's deletion undoes its
insertion exactly.  Per shard, the keys that enough documents hold are put in a cuckoo
filter; the lines of a document are asked of their shard's filter first, and what passes is
settled by the exact counts beside it.

A key is a line without the white space ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in
lower case, as a 128-bit digest.  Defined results: a null text is one empty line; a document
counts once for a key however often it holds it, and every row is a document of its own; keys
shorter than ``min_chars`` code points are never dropped; deleting what was never inserted
leaves no negative count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docspark.llm import words as wd

# Frequent keys that one shard should hold.
SHARD_KEYS = 50_000
# Probes of one shard are dealt to tasks of about this many, each with the shard's filter.
SALT_PROBES = 250_000
SLOTS = 4
KICKS = 500


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; supports insertion and deletion."""

    def __init__(self, room: int) -> None:
        self.mask = (1 << max(1, int(np.ceil(np.log2(max(room, 4) / (SLOTS * 0.9)))))) - 1
        self.table = np.zeros((self.mask + 1, SLOTS), np.uint16)
        self.homeless: list[tuple[int, int]] = []

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of 64-bit keys."""
        print_ = (keys >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
        first = (wd.mix(keys) & np.uint64(self.mask)).astype(np.int64)
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_: np.ndarray) -> np.ndarray:
        return (wd.mix(print_.astype(np.uint64) + np.uint64(77)) & np.uint64(self.mask)).astype(np.int64)

    def insert(self, keys: np.ndarray) -> None:
        for print_, first, second in zip(*(x.tolist() for x in self._places(keys))):
            if not (self._put(print_, first) or self._put(print_, second)):
                self._move(print_, second)

    def _put(self, print_: int, bucket: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = print_
        return bool(len(free))

    def _move(self, print_: int, bucket: int) -> None:
        """Push another fingerprint to its other bucket until one finds room."""
        for kick in range(KICKS):
            slot = kick % SLOTS
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
            bucket ^= int(self._jump(np.array([print_], np.uint16))[0])
            if self._put(print_, bucket):
                return
        self.homeless.append((print_, bucket))  # nothing is lost when the table is full

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted before."""
        for print_, first, second in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (first, second):
                slot = np.flatnonzero(self.table[bucket] == print_)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break
                if (print_, bucket) in self.homeless:
                    self.homeless.remove((print_, bucket))
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the filter; never false for one that is."""
        print_, first, second = self._places(keys)
        found = (self.table[first] == print_[:, None]).any(axis=1)
        found |= (self.table[second] == print_[:, None]).any(axis=1)
        for lost, bucket in self.homeless:
            found |= (print_ == lost) & ((first == bucket) | (second == bucket))
        return found


def _digests(texts: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with a key: its document, its number in it, and its digest (two words)."""
    owners, places, keys = [], [], []
    for i, text in enumerate(texts.to_pylist()):
        for k, line in enumerate(text.split(b"\n")):
            key = line.strip().lower()
            if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                owners.append(i)
                places.append(k)
                keys.append(key)
    column = pa.array(keys, pa.large_binary())
    digest = np.zeros((len(keys), 2), np.uint64)
    data, offsets = wd.buffers(column)
    if len(keys):
        for part, salt in ((0, 3), (1, 5)):
            digest[:, part] = _hash(data, offsets, salt)
    return np.array(owners, np.int64), np.array(places, np.int32), digest


_rng = np.random.Generator(np.random.PCG64(4321))
_VALUES = _rng.integers(0, 2**63, (8, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hash(data: np.ndarray, offsets: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit fingerprint of each byte string."""
    n = np.diff(offsets)
    full = n > 0
    place = (np.arange(len(data)) - np.repeat(offsets[:-1], n)).astype(np.uint64)
    value = wd.mix(_VALUES[salt][data] + place * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros(len(n), np.uint64)
    if full.any():
        out[full] = np.add.reduceat(value, offsets[:-1][full])
    return wd.mix(out + n.astype(np.uint64))


def _binary(digest: np.ndarray) -> pa.Array:
    data = pa.py_buffer(np.ascontiguousarray(digest.byteswap()))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(digest), [None, data]).cast(pa.binary())


def references(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """The state for these documents: every key and the number of documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            for i, j in wd.slices(texts):
                owner, _, digest = _digests(texts.slice(i, j - i), min_chars)
                whole = np.column_stack([digest, owner.astype(np.uint64)])
                once = np.unique(whole, axis=0)[:, :2] if len(whole) else digest
                keys, n = np.unique(once, axis=0, return_counts=True) if len(once) else (once, np.zeros(0, int))
                yield pa.RecordBatch.from_pydict({"key": _binary(keys), "n_docs": pa.array(n, pa.int64())})

    counted = docs.select("text").mapInArrow(run, "key binary, n_docs long")
    return counted.groupBy("key").agg(F.sum("n_docs").alias("n_docs"))


def insert(state: DataFrame, docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """The state after these documents came."""
    return _changed(state, references(docs, min_chars))


def delete(state: DataFrame, docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """The state after these documents went."""
    return _changed(state, references(docs, min_chars).withColumn("n_docs", -F.col("n_docs")))


def _changed(state: DataFrame, change: DataFrame) -> DataFrame:
    both = state.select("key", "n_docs").unionByName(change)
    return both.groupBy("key").agg(F.sum("n_docs").alias("n_docs")).where("n_docs > 0")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def dropped_lines(docs: DataFrame, state: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The numbers of the lines that go, as (doc_id, text_hash, lines), for rows that lose any.

    ``text_hash`` tells rows apart that repeat a doc_id with another text.
    """
    often = F.col("n_docs") >= min_docs
    frequent = state.where(often).select("key", "n_docs")
    n, lines = state.agg(F.count_if(often), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    shards = max(1, -(-n // SHARD_KEYS))
    salts = max(1, -(-lines // (shards * SALT_PROBES)))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wd.texts_of(batch.column("text"))
            for i, j in wd.slices(texts):
                part = texts.slice(i, j - i)
                owner, place, digest = _digests(part, min_chars)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": _binary(digest),
                        "doc_id": batch.column("doc_id").slice(i, j - i).take(pa.array(owner)),
                        "text_hash": batch.column("text_hash").slice(i, j - i).take(pa.array(owner)),
                        "line": pa.array(place),
                    }
                )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_now, exact, passed = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, where = batch.column("kind").to_numpy(), batch.column("shard").to_numpy()
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), "S16")
            short = keys.view(">u8").reshape(-1, 2)[:, 0].astype(np.uint64)
            hit = np.zeros(batch.num_rows, bool)
            for value in np.unique(where):
                rows = np.flatnonzero(where == value)
                new, asked = rows[kind[rows] == 0], rows[kind[rows] == 1]
                if value != shard_now:
                    shard_now, exact, passed = value, set(), CuckooFilter(2 * SHARD_KEYS)
                if len(new):
                    exact.update(keys[new].tolist())
                    passed.insert(short[new])
                maybe = asked[passed.contains(short[asked])] if len(asked) else asked
                hit[maybe] = [key in exact for key in keys[maybe].tolist()]
            yield batch.filter(pa.array(hit)).select(["doc_id", "text_hash", "line"])

    asked = docs.select(F.col("doc_id").cast("long"), "text", _text_hash())
    asked = asked.mapInArrow(probe, "key binary, doc_id long, text_hash long, line int")
    salt = F.pmod(F.xxhash64("doc_id", "line"), F.lit(salts)).cast("int")
    asked = asked.select(shard, salt.alias("salt"), F.lit(1).alias("kind"), "key", "doc_id", "text_hash", "line")
    known = frequent.select(
        shard,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.lit(0).alias("kind"),
        "key",
        *[F.lit(None).cast(kind).alias(c) for c, kind in (("doc_id", "long"), ("text_hash", "long"), ("line", "int"))],
    )
    rows = asked.unionByName(known).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    hits = rows.mapInArrow(look_up, "doc_id long, text_hash long, line int")
    return hits.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines"))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def judged(docs: DataFrame, state: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Every document with the lines that stay.

    The result has ``row``, all columns of ``docs`` as they were, ``kept``, the remaining
    lines, ``n_lines`` and ``n_dropped``.
    """
    gone = dropped_lines(docs, state, min_docs, min_chars)
    gone = gone.select(F.struct("doc_id", "text_hash").alias("of"), "lines")
    whole = docs.select(
        F.struct(*docs.columns).alias("row"), F.struct(F.col("doc_id").cast("long"), _text_hash()).alias("own")
    )
    both = whole.join(gone, F.col("own").eqNullSafe(F.col("of")), "left")
    text = F.coalesce("row.text", F.lit(""))
    both = both.select(
        "row", text.alias("text"), F.split(text, "\n", -1).alias("all"), F.coalesce("lines", F.array().cast("array<int>")).alias("lines")
    )
    number = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), "lines")
    stay = F.concat_ws("\n", F.transform(number, lambda i: F.get("all", i)))
    return both.select(
        "row",
        F.when(F.size("lines") == 0, F.col("text")).otherwise(stay).alias("kept"),
        F.size("all").cast("long").alias("n_lines"),
        F.size("lines").cast("long").alias("n_dropped"),
    )
