"""Documents in compressed pieces, and compact columns of fingerprints.

Operators that look up a fingerprint for every word would shuffle more bytes than the texts
have.  They work on pieces instead: some megabytes of documents together, written once, so
that a fingerprint travels once per piece and not once per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docspark.llm import words as wd
from docspark.sources import staging

# Text that one piece holds; a longer document is a piece of its own.
PIECE_BYTES = 8_000_000
# Text whose fingerprints meet in one bucket.
BUCKET_BYTES = 24_000_000

SCHEMA = "ids array<long>, lengths array<long>, bytes long, packed binary"


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unsqueeze(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers, small ones in little space: byte planes, compressed."""
    return squeeze(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(keys.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def isin_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among these ascending ones."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def buckets(keys: np.ndarray, bits: int, width: int = 64) -> Iterator[tuple[int, slice]]:
    """Cut ascending keys of ``width`` bits by their ``bits`` highest ones."""
    if not bits:
        if len(keys):
            yield 0, slice(0, len(keys))
        return
    which = (keys >> np.uint64(width - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(which, prepend=-1, append=-1))
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        yield int(which[a]), slice(a, b)


@dataclass
class Piece:
    ids: pa.Array
    texts: pa.Array

    @property
    def order(self) -> np.ndarray:
        """The ids as numbers; a null id comes after all others."""
        return self.ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)

    def hashes(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Word fingerprints, and where each document's first one is."""
        found, first, total = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
        for i, j in wd.slices(self.texts):
            w = wd.words(self.texts.slice(i, j - i), lower)
            found.append(w.hashes())
            first.append(w.first[1:] + total)
            total += len(w.starts)
        return np.concatenate(found), np.concatenate(first)


def cut(docs: DataFrame) -> tuple[DataFrame, int]:
    """Write documents (doc_id, text) as numbered pieces; also the bytes of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), wd.texts_of(batch.column("text"))):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= PIECE_BYTES:
                    yield row(ids, texts, held)
                    ids, texts, held = [], [], 0
        if ids:
            yield row(ids, texts, held)

    def row(ids: list[int | None], texts: list[bytes], held: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "lengths": pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                "bytes": pa.array([held], pa.int64()),
                "packed": pa.array([squeeze(b"".join(texts))], pa.binary()),
            }
        )

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
    # Numbered once: the written table keeps the numbers.
    written, _ = staging.stage(made.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    return written, written.agg(F.sum("bytes")).first()[0] or 0


def open_piece(batch: pa.RecordBatch | pa.Table, i: int = 0) -> Piece:
    ids = pa.array(batch.column("ids")[i].as_py(), pa.int64())
    lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
    data = unsqueeze(batch.column("packed")[i].as_py())
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return Piece(ids, texts)


def bucket_bits(total: int) -> int:
    """Buckets for so many bytes of text, as a power of two."""
    return max(0, int(np.ceil(np.log2(max(1, total / BUCKET_BYTES)))))
