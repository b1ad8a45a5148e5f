"""Substring dedup by fixed-block anchors.

A run of ``window`` words that two documents share holds a whole block of the other document,
if every document is indexed in blocks of half a window that do not overlap.  So all blocks
are indexed, and every rolling run of that many words is probed.  Hits are extended: adjoining
hits make up the candidates, and each window of a candidate is settled by its own fingerprint
and the smallest document that holds it, which gives the maximal exact repeats.

Fingerprints travel by piece of some megabytes of text (see ``pieces``): the index and the
probes with as many bits as keep false hits below one in a hundred, the windows with 64 bits.

Defined results: a null text has no words; a document of fewer words than a window keeps all;
a null id counts as larger than all others; rows that repeat a doc_id don't remove each
other's words; a run that a document repeats within itself stays.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docspark.llm import pieces as pc
from docspark.llm import words as wd
from docspark.sources import staging


def _anchors(h: np.ndarray, first: np.ndarray, block: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all rolling runs, which of them lie in one document, and which are blocks."""
    keys = wd.grams(h, block) >> np.uint64(64 - width)
    real = wd.inside(first, block)
    place = np.arange(len(keys)) - np.repeat(first[:-1], np.diff(first))[: len(keys)]
    return keys, real, real & (place % block == 0)


def _index(packed: DataFrame, block: int, width: int, bits: int) -> DataFrame:
    """Blocks and probes of every piece, by bucket."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                h, first = pc.open_piece(batch, i).hashes()
                keys, real, blocks = _anchors(h, first, block, width)
                known, asked = np.unique(keys[blocks]), np.unique(keys[real])
                known_in = dict(pc.buckets(known, bits, width))
                rows = [
                    (bucket, pc.pack_sorted(known[known_in.get(bucket, slice(0, 0))]), pc.pack_sorted(asked[part]))
                    for bucket, part in pc.buckets(asked, bits, width)
                ]
                columns = list(zip(*rows)) or [[]] * 3
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(columns[0], pa.int32()),
                        "piece": pa.array([batch.column("piece")[i].as_py()] * len(rows), pa.int64()),
                        "blocks": pa.array(columns[1], pa.binary()),
                        "probes": pa.array(columns[2], pa.binary()),
                    }
                )

    return packed.mapInArrow(run, "bucket int, piece long, blocks binary, probes binary")


def _hits(group: pa.Table) -> pa.Table:
    """For each piece its probes that are a block of another piece."""
    pieces = group.column("piece").to_pylist()
    blocks = [pc.unpack_sorted(b.as_py()) for b in group.column("blocks")]
    every = np.concatenate(blocks)
    owner = np.repeat(np.arange(len(pieces)), list(map(len, blocks)))
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    keys, begin, counts = np.unique(every, return_index=True, return_counts=True)
    sole = np.where(counts > 1, -1, owner[begin])
    found = []
    for i, probes in enumerate(group.column("probes")):
        asked = pc.unpack_sorted(probes.as_py())
        if len(keys):
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            asked = asked[(keys[at] == asked) & (sole[at] != i)]
        else:
            asked = asked[:0]
        found.append(pc.pack_sorted(asked))
    return pa.table({"piece": pa.array(pieces, pa.int64()), "hits": pa.array(found, pa.binary())})


def _candidates(window: int, block: int, width: int, bits: int):
    """Windows of a piece that hold a hit, with the smallest document of each."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for i in range(left.num_rows):
            piece = pc.open_piece(left, i)
            h, first = piece.hashes()
            keys, real, blocks = _anchors(h, first, block, width)
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(keys)]
            known = np.sort(np.concatenate([np.zeros(0, np.uint64), *[pc.unpack_sorted(x.as_py()) for x in right.column("hits")]]))
            hit = real & pc.isin_sorted(keys, known)
            # Blocks of other documents of the same piece.
            own, owner = keys[blocks], doc[blocks]
            order = np.argsort(own, kind="stable")
            own, owner = own[order], owner[order]
            if len(own):
                low = np.searchsorted(own, keys, "left")
                at = np.minimum(low, len(own) - 1)
                same = own[at] == keys
                last = np.maximum(np.searchsorted(own, keys, "right") - 1, 0)
                hit |= real & same & ((owner[at] != doc) | (owner[last] != doc))
            total = np.concatenate([[0], np.cumsum(hit)])
            whole = wd.inside(first, window)
            n = len(whole)
            reach = window - block + 1
            chosen = whole & (total[reach : reach + n] > total[:n])
            prints = wd.grams(h, window)[chosen]
            ids = piece.order[doc[:n][chosen]]
            order = np.lexsort((ids, prints))
            prints, begin = np.unique(prints[order], return_index=True)
            ids = ids[order][begin]
            for bucket, part in pc.buckets(prints, bits):
                base = int(ids[part].min())
                rows.append(
                    (bucket, left.column("piece")[i].as_py(), pc.pack_sorted(prints[part]), base,
                     pc.pack((ids[part] - base).astype(np.uint64)))
                )
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        names = ["bucket", "piece", "prints", "base", "ids"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _earlier(group: pa.Table) -> pa.Table:
    """For each piece its windows that a smaller document of another piece holds."""
    prints = [pc.unpack_sorted(x.as_py()) for x in group.column("prints")]
    ids = [
        pc.unpack(x.as_py()).astype(np.int64) + b
        for x, b in zip(group.column("ids"), group.column("base").to_pylist())
    ]
    every, smallest = np.concatenate(prints), np.concatenate(ids)
    order = np.lexsort((smallest, every))
    keys, begin = np.unique(every[order], return_index=True)
    smallest = smallest[order][begin]
    found = [pc.pack_sorted(p[smallest[np.searchsorted(keys, p)] < i]) for p, i in zip(prints, ids)]
    return pa.table({"piece": group.column("piece"), "removed": pa.array(found, pa.binary())})


def _cleaned(window: int):
    """The documents of a piece without the words of repeated windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for i in range(left.num_rows):
            piece = pc.open_piece(left, i)
            h, first = piece.hashes()
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            whole = wd.inside(first, window)
            prints = wd.grams(h, window)
            removed = np.sort(np.concatenate([np.zeros(0, np.uint64), *[pc.unpack_sorted(x.as_py()) for x in right.column("removed")]]))
            gone = whole & pc.isin_sorted(prints, removed)
            # Windows that a smaller document of the same piece holds.
            at = np.flatnonzero(whole)
            ids = piece.order[doc[at]]
            order = np.lexsort((ids, prints[at]))
            at, ids = at[order], ids[order]
            begin = np.flatnonzero(np.diff(prints[at], prepend=~prints[at[:1]])) if len(at) else at
            smallest = np.repeat(ids[begin], np.diff(begin, append=len(at)))
            gone[at] |= smallest < ids
            lost = wd.covered(gone, window, len(h))
            counts = wd.per_doc(first, lost)
            kept = []
            stay = ~lost
            for k, text in enumerate(piece.texts):
                parts = text.as_py().split()
                if counts[k]:
                    parts = compress(parts, stay[first[k] : first[k + 1]].tolist())
                kept.append(b" ".join(parts))
            tables.append(
                pa.table(
                    {
                        "doc_id": piece.ids,
                        "n_words": pa.array(np.diff(first), pa.int64()),
                        "n_removed": pa.array(counts, pa.int64()),
                        "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                    }
                )
            )
        return pa.concat_tables(tables)

    return run


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """Every document without the words of windows that a smaller document holds.

    ``docs`` has doc_id and text.  The result has doc_id, n_words, n_removed and kept, the
    remaining words joined by single spaces.
    """
    block = (window + 1) // 2
    packed, total = pc.cut(docs)
    bits = pc.bucket_bits(total)
    # About one block in 40 bytes of text; eight bits more keep false hits rare.
    width = min(64, max(bits, int(np.ceil(np.log2(max(2, total / 40)))) + 8))

    index = _index(packed, block, width, bits)
    hits = index.groupBy("bucket").applyInArrow(_hits, "piece long, hits binary")
    both = packed.groupBy("piece").cogroup(hits.groupBy("piece"))
    windows = both.applyInArrow(
        _candidates(window, block, width, bits), "bucket int, piece long, prints binary, base long, ids binary"
    )
    removed = windows.groupBy("bucket").applyInArrow(_earlier, "piece long, removed binary")
    removed, _ = staging.stage(removed, "removed")
    both = packed.groupBy("piece").cogroup(removed.groupBy("piece"))
    return both.applyInArrow(_cleaned(window), "doc_id long, n_words long, n_removed long, kept string")
