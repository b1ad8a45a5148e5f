"""Words and their fingerprints, straight from Arrow text buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Text is walked in slices of about this many bytes, so that a task's arrays stay small.
SLICE_BYTES = 1_000_000

# The white space of all word patterns, [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# Lower-cases A-Z in UTF-8 bytes and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.Generator(np.random.PCG64(20_250_601))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[SPACE] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = 1 << 12
_PLACE = np.cumprod(np.full(_PLACES, np.uint64(0xD6E8FEB86659FD93)))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of a run of documents, in order."""

    data: np.ndarray  # bytes of all documents
    offsets: np.ndarray  # where each document starts in data, and the end
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    first: np.ndarray  # of each document: its first word, and the end

    @property
    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit fingerprint of each word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        place = np.arange(len(self.data), dtype=np.int64)
        begin = int(self.starts[0])
        place[begin:] -= np.repeat(self.starts, np.diff(self.starts, append=len(self.data)))
        value = _BYTE[self.data]
        value *= _PLACE[place & (_PLACES - 1)]
        far = place >= _PLACES  # only words of thousands of bytes get so far
        if far[begin:].any():
            far[:begin] = False
            value[far] = mix(value[far] + (place[far] >> 12).astype(np.uint64)) * (value[far] != 0)
        length = (self.ends - self.starts).astype(np.uint64)
        return mix(np.add.reduceat(value, self.starts) + length)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as bytes with 64-bit offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts together, and where each starts."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``most`` bytes; a larger text is a run of its own."""
    _, offsets = buffers(texts)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield at, end
        at = end


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Find the words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = edge[:-1].copy(), edge[1:].copy()
    begins[1:] |= ~word[:-1]
    ends[:-1] |= ~word[1:]
    starts = np.flatnonzero(word & begins)
    return Words(data, offsets, starts, np.flatnonzero(word & ends) + 1, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of n words; entry i starts at word i."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out = out * _STEP + hashes[j : j + count]
    return mix(out)


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n words lie in one document."""
    total = int(first[-1])
    ok = np.zeros(total + 1, np.int32)
    sizes = np.diff(first)
    long = sizes >= n
    np.add.at(ok, first[:-1][long], 1)
    np.add.at(ok, first[1:][long] - n + 1, -1)
    return np.cumsum(ok[: max(0, total - n + 1)]) > 0


def covered(flags: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words under at least one flagged run of n words."""
    step = np.zeros(total + 1, np.int32)
    step[: len(flags)] += flags
    step[n : n + len(flags)] -= flags
    return np.cumsum(step[:total]) > 0


def per_doc(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of per-word values by document."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
