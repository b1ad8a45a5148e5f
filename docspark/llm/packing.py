"""Best-fit packing of token pieces with large-item matching.

Every document becomes token ids and an end id; longer ones are cut into pieces.  Only the
numbers of pieces by length decide how bins are filled, so the plan is made from a table of
at most ``capacity`` rows: pieces above a third of the capacity are matched greedily, at most
two to a bin, each longest one with the longest that still fits; smaller pieces, longest
first, go to the tightest gap.  Pieces of equal length are interchangeable: each learns its
place from its rank among the pieces of its length.

Defined results: a null text is empty and becomes a piece of one end id; repeated rows are
packed once each.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from docspark.sources import staging

CAPACITY = 2048
END = b"\0\0\0\0"
# Ranks are counted within a length in this many groups of documents, so that a common
# length is not ranked in one place.
RANK_GROUPS = 512
# Word pieces whose ids a Python worker remembers.
REMEMBERED = 400_000

# Where one of these stands, a text is not cut at single spaces but encoded whole.
_ODD = re.compile(r"^\s|\s$| \s|\s |[^\S \t\n\x0b\f\r]")
# Beyond this the two libraries may know different Unicode versions.
_FAR = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")


class Ids:
    """Token ids of texts as bytes, little-endian and unsigned."""

    def __init__(self, path: str) -> None:
        self.exact = Tokenizer.from_file(path)
        spec = re.sub(r"\.json$", ".tiktoken", path)
        self.fast = _fast(spec) if spec != path else None
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if self.fast is None or _FAR.search(text) or "<|" in text:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _ODD.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        # A single space between other characters always begins a token.
        head, *rest = text.split(" ")
        found = list(map(self.known.get, rest))
        if None in found:
            found = [self._word(w) if ids is None else ids for w, ids in zip(rest, found)]
        return np.array(self.fast.encode_ordinary(head), "<u4").tobytes() + b"".join(found)

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            ids = np.array(self.fast.encode_ordinary(" " + word), "<u4").tobytes()
            if len(word) < 100:
                self.known[word] = ids
        return ids


def _fast(path: str) -> tiktoken.Encoding | None:
    """The same vocabulary in the faster library, if its file lies beside the other."""
    import base64

    import public_tokenizers

    try:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    except FileNotFoundError:
        return None
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _ids(path: str) -> Ids:
    return Ids(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document (doc_id, text): their place in it, length and checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = ids_of(text.as_py() or "") + END
                n = len(ids) // 4
                start, length = 0, n % capacity or capacity
                piece = 0
                while start < n:
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    start, length, piece = start + length, capacity, piece + 1
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class Plan:
    """Where the pieces of each length go.

    ``segments[length]`` lists (first rank, first bin, pieces per bin, offset in the bin): the
    pieces from that rank on fill one bin after the other.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.segments: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.bins = 0
        self.placed: dict[int, int] = defaultdict(int)
        # Runs of bins that look alike: (gap, first bin, number of bins), by gap.
        self.open: list[tuple[int, int, int]] = []
        left = {length: n for length, n in counts.items() if n}
        self._match(left, capacity)
        for length in sorted(left, reverse=True):
            self._fit(length, left[length], capacity)

    def _put(self, length: int, first: int, bins: int, each: int, offset: int) -> None:
        self.segments[length].append((self.placed[length], first, each, offset))
        self.placed[length] += bins * each

    def _new(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def _match(self, left: dict[int, int], capacity: int) -> None:
        """Pair pieces above a third of the capacity, the longest first."""
        large = sorted(length for length in left if 3 * length > capacity)
        while large:
            a = large[-1]
            fits = [b for b in large if a + b <= capacity]
            b = fits[-1] if fits else 0
            if b == a:
                n = left[a] // 2
                b = b if n else (fits[-2] if len(fits) > 1 else 0)
            if not b:
                n, gap = left[a], capacity - a
            elif a != b:
                n, gap = min(left[a], left[b]), capacity - a - b
            else:
                gap = capacity - a - b
            first = self._new(n)
            if a == b:
                self._put(a, first, n, 2, 0)
                left[a] -= 2 * n
            else:
                self._put(a, first, n, 1, 0)
                left[a] -= n
                if b:
                    self._put(b, first, n, 1, a)
                    left[b] -= n
            if gap:
                insort(self.open, (gap, first, n))
            for length in {a, b} & set(large):
                if not left[length]:
                    large.remove(length)
                    del left[length]

    def _fit(self, length: int, n: int, capacity: int) -> None:
        """Best fit: the tightest gap takes as many pieces as it holds, then the next."""
        while n:
            at = bisect_left(self.open, (length,))
            if at < len(self.open):
                gap, first, bins = self.open.pop(at)
            else:
                bins = -(-n // (capacity // length))
                gap, first = capacity, self._new(bins)
            each = min(gap // length, n)
            full = min(bins, n // each)
            self._put(length, first, full, each, capacity - gap)
            n -= full * each
            if gap - each * length:
                insort(self.open, (gap - each * length, first, full))
            if bins > full:
                insort(self.open, (gap, first + full, bins - full))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The sequence and the offset of every piece; ``cut`` is a written table of pieces."""
    # Few rows whatever the input: there are at most ``capacity`` lengths.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(counts, capacity)
    segments = {
        length: tuple(np.array(column, np.int64) for column in zip(*rows)) for length, rows in plan.segments.items()
    }

    # The rank of a piece among those of its length: pieces of earlier groups, then its own.
    cut = cut.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(RANK_GROUPS)).cast("int"))
    sizes = cut.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(own) - 1).join(sizes, ["length", "group"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("group", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                rows = np.flatnonzero(length == value)
                first_rank, first_bin, each, place = segments[int(value)]
                s = np.searchsorted(first_rank, rank[rows], "right") - 1
                nth = rank[rows] - first_rank[s]
                sequence[rows] = first_bin[s] + nth // each[s]
                offset[rows] = place[s] + nth % each[s] * value
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in batch.schema.names if c != "rank"}
                | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut documents into pieces and pack them into as few sequences as the method finds."""
    cut, _ = staging.stage(pieces(docs, tokenizer, capacity), "pieces")
    return pack(cut, capacity)
