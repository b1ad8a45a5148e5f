import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docspark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def laid(plan, counts):
    bins = defaultdict(list)
    for length, n in counts.items():
        segments = plan.segments.get(length, [])
        for rank in range(n):
            first, at, each, offset = [s for s in segments if s[0] <= rank][-1]
            bins[at + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    return bins


def test_plans_are_gapless_and_within_capacity():
    rng = random.Random(4)
    for _ in range(150):
        capacity = rng.choice([10, 30, 100])
        lengths = rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 20)))
        counts = {length: rng.randint(0, 6) for length in lengths}
        plan = packing.Plan(counts, capacity)
        bins = laid(plan, counts)
        assert len(bins) == plan.bins
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity


def test_large_pieces_are_matched_as_well_as_can_be():
    def best(items, capacity):  # all pairings of pieces above a third
        if not items:
            return 0
        first, *rest = items
        found = 1 + best(rest, capacity)
        for i, other in enumerate(rest):
            if first + other <= capacity:
                found = min(found, 1 + best(rest[:i] + rest[i + 1 :], capacity))
        return found

    rng = random.Random(8)
    for _ in range(60):
        items = [rng.randint(11, 30) for _ in range(rng.randint(1, 8))]
        counts = {x: items.count(x) for x in items}
        assert packing.Plan(counts, 30).bins == best(items, 30)


def test_ids_equal_the_tokenizer():
    exact, ids = Tokenizer.from_file(PATH), packing.Ids(PATH)
    rng = random.Random(5)
    parts = ["a", "B", " ", "  ", "\n", ".", "1", "'s", "'", "\xe9", "字", "\t", "\xa0", "<|endoftext|>", "\xbd", "​", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert ids(text) == np.array(exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


ROWS = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "no id"), (4, "word " * 5000), (5, "a b c " * 300)]


def test_pieces_and_sequences(spark, docs_of):
    rows = packing.pack_documents(docs_of(ROWS), PATH, capacity=512).collect()
    exact = Tokenizer.from_file(PATH)
    total = 0
    for doc_id, text in set(ROWS):
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        copies = ROWS.count((doc_id, text))
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert sum(r.length for r in own) == copies * len(ids)
        assert all(r.length == 512 for r in own if r.piece)
        total += copies * len(ids)
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= -(-total // 512) + 1


def test_no_documents(spark, docs_of):
    assert packing.pack_documents(docs_of([]), PATH).collect() == []
