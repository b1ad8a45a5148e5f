"""Byte-level BPE by a global shuffle of distinct words; decoding by the token-byte table.

Most pre-tokens repeat, so merging is done once per distinct one:

1. Documents are gathered in blocks of some megabytes.  A block numbers its distinct
   pre-tokens and keeps, for every position, the number of what stands there.  Blocks are
   shuffled once, and both later steps read that one shuffle.
2. The distinct pre-tokens of a block are exploded by the bucket of their hash; a row holds
   those of one block and bucket with their numbers.  Rows are shuffled by bucket,
   whose task merges each distinct pre-token once, whatever number of blocks has it.
3. The ids go back to their blocks, are joined to the positions and cut at the ends of the
   documents.

A pre-token crosses the network at most once per block each way, a frequent one as well as a
rare one, so no key is hot, and no table of words is held as a whole anywhere.

Blocks are made anew if an executor is lost, so documents must come in a stable order, as they
do from files; a block whose content has changed since its pre-tokens were sent out is an error,
not a wrong result.

Defined results: a null or empty text has no ids; bytes that are no UTF-8 count as U+FFFD;
repeated rows are encoded once each; further columns are left out.
"""

from __future__ import annotations

import base64
import heapq
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from docspark.llm import pieces as pc, words as wd

# Text that one block holds; a longer document is a block of its own.
BLOCK_BYTES = 8_000_000
# Text whose distinct pre-tokens meet in one bucket.
BUCKET_BYTES = 24_000_000
# Text that is split into pre-tokens at a time.
SPLIT_BYTES = 1_000_000
# Pre-tokens of up to so many bytes are merged by plain search for the best pair.
SHORT = 100
_NONE = 1 << 32

OTHER, LETTER, NUMBER, SPACE, END = range(5)
# Where a long text may be cut.
_GAP = re.compile(rb"[A-Za-z](?= )")
# Masks of the lowest 0 to 8 bytes of a number.
_LOWEST = np.array([256**n - 1 for n in range(9)], np.uint64)

# One packed column, so that both readers of a block need the same columns of the shuffle.
BLOCK = "held struct<ids: array<long>, counts: array<long>, places: binary, sizes: binary, words: binary>"
BACK = "block long, crc long, numbers binary, sizes binary, tokens binary"
HELD = pa.struct(
    [(c, pa.list_(pa.int64())) for c in ("ids", "counts")] + [(c, pa.binary()) for c in ("places", "sizes", "words")]
)
ENCODED = "doc_id long, n_tokens long, tokens binary"


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """The token bytes of a rank file and their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=1)
def classes() -> bytes:
    """The class of every character, by the Unicode version of the tokenizer library, compressed."""
    import tiktoken  # heavy, and needed on the driver only

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    bytewise = {bytes([i]): i for i in range(256)}
    for name, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        library = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=bytewise, special_tokens={})
        table[_points(bytes(library.encode_ordinary(every)).decode())] = kind
    return pc.squeeze(table.tobytes())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def parts_of(text: bytes) -> list[str]:
    """A long text in parts, cut where a blank follows a letter: there a pre-token always ends."""
    parts, at = [], 0
    while at < len(text):
        cut = _GAP.search(text, at + SPLIT_BYTES) if at + SPLIT_BYTES < len(text) else None
        end = cut.start() + 1 if cut else len(text)
        parts.append(text[at:end].decode(errors="replace"))
        at = end
    return parts


def split(parts: list[str], kinds: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The pre-tokens of texts, as the tokenizer library finds them with the pattern

    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``

    Returns the bytes of all texts, where each pre-token begins and ends in them, and the
    numbers of pre-tokens by text.
    """
    joined = "\0".join(parts)
    points = _points(joined)
    kind = kinds[points]
    kind[np.cumsum([len(p) + 1 for p in parts])[:-1] - 1] = END
    space, word = kind == SPACE, kind < SPACE
    after_space = np.concatenate([[False], space[:-1]])
    before_word = np.concatenate([word[1:], [False]])
    after_blank = np.concatenate([[False], points[:-1] == 32])
    change = np.concatenate([[True], kind[1:] != kind[:-1]])[: len(kind)]
    # White space starts where its run does, and its last character where a word follows; a
    # word takes one blank before it.
    start = np.where(space, ~after_space[: len(kind)] | before_word[: len(kind)], change & ~after_blank[: len(kind)])
    start |= kind == END
    quotes = np.flatnonzero(start & (points == 39))
    if len(quotes):
        padded = np.concatenate([points, [0, 0]])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, _points("stmd"))
        long = (np.isin(one, _points("rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        start[quotes[short | long] + 1] = False
        ends = np.concatenate([quotes[short] + 2, quotes[long] + 3])
        start[ends[ends < len(points)]] = True
    starts = np.flatnonzero(start)
    real = kind[starts] != END
    counts = np.bincount(np.cumsum(~real)[real], minlength=len(parts))
    edges = np.append(starts, len(points))
    if not joined.isascii():
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        edges = np.concatenate([[0], np.cumsum(width)])[edges]
    return joined.encode(), edges[:-1][real], edges[1:][real], counts


def merged(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is joined first, the leftmost of equal ones."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > SHORT:
        return _merged_long(ranks, word)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while pairs:
        best = min(pairs)
        if best == _NONE:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
    return [ranks[part] for part in parts]


def _merged_long(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """The same with a heap of pairs, for words of any length."""
    n = len(word)
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = after[i]
        if middle < 0 or middle >= n or after[middle] != end:
            continue  # one of the two parts has been joined since
        after[i], after[middle] = end, -1
        if end < n:
            before[end] = i
            rank = ranks.get(word[i : after[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, after[end]))
        if before[i] >= 0:
            rank = ranks.get(word[before[i] : end])
            if rank is not None:
                heapq.heappush(heap, (rank, before[i], end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : after[i]]])
        i = after[i]
    return ids


def blocks(docs: DataFrame, tasks: int) -> DataFrame:
    """Numbered blocks of documents (doc_id, text).

    ``places`` has the number of the pre-token at each position, ``words`` the distinct
    pre-tokens by number, the most frequent first.
    """
    packed = classes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = np.frombuffer(pc.unsqueeze(packed), np.uint8)
        block = _Block(kinds)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), wd.texts_of(batch.column("text"))):
                block.add(doc_id, text.as_py())
                if block.bytes >= BLOCK_BYTES:
                    yield block.row()
                    block = _Block(kinds)
        if block.ids:
            yield block.row()

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK)
    return made.withColumn("block", F.monotonically_increasing_id()).repartition(tasks, "block")


def _distinct(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct pre-tokens, and which of them stands at each position.

    Those of up to 15 bytes are compared as two numbers, the second of which has the length; a
    longer one stands by itself.
    """
    sizes = ends - begins
    # The eight bytes from any place on, as one number.
    eight = np.ndarray(len(data) + 9, "<u8", data + bytes(16), strides=(1,))
    low = eight[begins] & _LOWEST[np.minimum(sizes, 8)]
    high = eight[np.minimum(begins + 8, len(data))] & _LOWEST[np.clip(sizes - 8, 0, 7)]
    far = sizes > 15
    high |= np.minimum(sizes, 16).astype(np.uint64) << np.uint64(56)
    low[far] = np.flatnonzero(far)
    a, _ = pd.factorize(low)
    b, second = pd.factorize(high)
    which, pairs = pd.factorize(a.astype(np.int64) * len(second) + b)
    place = np.empty(len(pairs), np.int64)
    place[which[::-1]] = np.arange(len(which))[::-1]
    return [data[i:j] for i, j in zip(begins[place].tolist(), ends[place].tolist())], which


class _Block:
    """Documents whose pre-tokens are numbered together."""

    def __init__(self, kinds: np.ndarray) -> None:
        self.kinds = kinds
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.places: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.number: dict[bytes, int] = {}
        self.bytes = 0
        self.waiting: list[tuple[int, str]] = []
        self.held = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(0)
        self.bytes += len(text)
        for part in parts_of(text):
            self.waiting.append((len(self.ids) - 1, part))
            self.held += len(part)
            if self.held >= SPLIT_BYTES:
                self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        data, begins, ends, counts = split([part for _, part in self.waiting], self.kinds)
        words, which = _distinct(data, begins, ends)
        number = self.number
        found = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words))
        self.places.append(found[which])
        for (i, _), count in zip(self.waiting, counts.tolist()):
            self.counts[i] += count
        self.waiting, self.held = [], 0

    def row(self) -> pa.RecordBatch:
        self.flush()
        words, places = list(self.number), np.concatenate(self.places)
        order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        held = {
            "ids": self.ids,
            "counts": self.counts,
            "places": pc.pack(rank[places]),
            "sizes": pc.pack(np.fromiter((len(words[i]) for i in order), np.uint64, len(order))),
            "words": pc.squeeze(b"".join(words[i] for i in order)),
        }
        return pa.RecordBatch.from_arrays([pa.array([held], HELD)], ["held"])


def _words_of(held: dict) -> list[bytes]:
    data, ends = pc.unsqueeze(held["words"]), np.cumsum(pc.unpack(held["sizes"]).astype(np.int64)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _exploded(blocks: DataFrame, bits: int) -> DataFrame:
    """One row per block and bucket: the numbers and bytes of its distinct pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, block in zip(batch.column("held").to_pylist(), batch.column("block").to_pylist()):
                words, crc = _words_of(held), zlib.crc32(held["words"])
                bucket = np.array([xxhash.xxh3_64_intdigest(w) >> (64 - bits) if bits else 0 for w in words], np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)).tolist() if words else []
                rows = []
                for a, b in zip(edges, edges[1:]):
                    own = order[a:b]
                    found = [words[i] for i in own]
                    sizes = pc.pack(np.fromiter(map(len, found), np.uint64))
                    rows.append((int(bucket[own[0]]), block, crc, pc.pack_sorted(own), sizes, pc.squeeze(b"".join(found))))
                columns = list(zip(*rows)) or [[]] * 6
                kinds = [pa.int64()] * 3 + [pa.binary()] * 3
                names = ["bucket", "block", "crc", "numbers", "sizes", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "bucket long, block long, crc long, numbers binary, sizes binary, words binary"
    return blocks.mapInArrow(run, schema)


def _merged_once(exploded: DataFrame, ranks: str, tasks: int) -> DataFrame:
    """Merge each distinct pre-token of a bucket once and send the ids back to its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks_of(ranks)
        current, known = None, {}
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["bucket"] != current:
                    current, known = r["bucket"], {}
                found = []
                for word in _words_of(r):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = merged(table, word)
                    found.append(ids)
                sizes = pc.pack(np.fromiter(map(len, found), np.uint64))
                rows.append((r["block"], r["crc"], r["numbers"], sizes, _pack_ids([i for ids in found for i in ids])))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64()] * 2 + [pa.binary()] * 3
            names = ["block", "crc", "numbers", "sizes", "tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return exploded.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(run, BACK)


def _pack_ids(ids: list[int]) -> bytes:
    """Few different ids make up most words, so each is sent once, and then its number."""
    codes, distinct = pd.factorize(np.array(ids, np.uint64))
    distinct = pc.pack(distinct)
    return len(distinct).to_bytes(8, "little") + distinct + pc.pack(codes)


def _unpack_ids(packed: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(packed[:8], "little")
    return pc.unpack(packed[8:end]).astype("<u4")[pc.unpack(packed[end:]).astype(np.int64)]


def _reassembled(key: tuple, block: pa.Table, back: pa.Table) -> pa.Table:
    """The ids of a block's documents: positions joined to the ids of their pre-tokens."""
    held = block.column("held")[0].as_py()
    if back.num_rows and set(back.column("crc").to_pylist()) != {zlib.crc32(held["words"])}:
        raise ValueError("documents came in another order when they were read again; write them to a table first")
    numbers, found_sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
    for n, size, ids in zip(*(back.column(c).to_pylist() for c in ("numbers", "sizes", "tokens"))):
        numbers.append(pc.unpack_sorted(n).astype(np.int64))
        found_sizes.append(pc.unpack(size).astype(np.int64))
        found.append(_unpack_ids(ids))
    number, length, tokens = map(np.concatenate, (numbers, found_sizes, found))
    sizes, starts = np.zeros_like(length), np.zeros_like(length)
    sizes[number], starts[number] = length, np.cumsum(length) - length
    ids, counts = held["ids"], held["counts"]
    places = pc.unpack(held["places"]).astype(np.uint32)
    found, n_tokens, at = [], [], 0
    for count in counts:
        own = places[at : at + count]
        at += count
        length = sizes[own]
        ends = np.cumsum(length)
        where = np.arange(ends[-1] if count else 0) + np.repeat(starts[own] - (ends - length), length)
        found.append(tokens[where].tobytes())
        n_tokens.append(len(where))
    return pa.table(
        {"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()), "tokens": pa.array(found, pa.binary())}
    )


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """Token ids of every document (doc_id, text) as little-endian unsigned 32-bit integers.

    ``ranks`` is the path of a rank file.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / BUCKET_BYTES))))
    held = blocks(docs, math.ceil(total / BLOCK_BYTES) + 1)
    back = _merged_once(_exploded(held, bits), ranks, 2**bits)
    return held.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_reassembled, ENCODED)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Add ``decoded``: the bytes of all tokens of a row, in order.

    The ids are joined to the token-byte table, which is as large as the vocabulary and no
    larger.  Null tokens, and those with an id that the table does not have, decode to null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = {i: word for word, i in ranks_of(ranks).items()}
        table = pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_binary())
        for batch in batches:
            found = []
            for row in batch.column("tokens"):
                row = row.as_py()
                ids = np.frombuffer(row or b"", "<u4")
                known = row is not None and (not len(ids) or ids.max() < len(table))
                words = table.take(pa.array(ids)) if known else None
                found.append(wd.buffers(words)[0].tobytes() if known and not words.null_count else None)
            yield batch.append_column("decoded", pa.array(found, pa.binary()))

    schema = encoded.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return encoded.mapInArrow(run, f"{schema},decoded:binary")
