"""Byte-level BPE against the tokenizer library, and round trips."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from docspark.llm import bpe, pieces as pc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    (1, "It's a test, isn't it? They'll say we're 'so' done's."),
    (2, None),
    (3, ""),
    (4, " \n\n  two  blanks \t\n"),
    (5, "naïve façade Straße 東京 ٣٤ 😀 x y\x1c\x85z"),
    (6, "word " * 30_000 + "end"),
    (7, "a" * 30_000),
    (8, "<|endoftext|> \U0001e030 ౜ 'S 'RE ''s"),
    (1, "It's a test, isn't it? They'll say we're 'so' done's."),
    (None, "no id"),
]


@pytest.fixture(scope="module")
def library():
    ranks = bpe.ranks_of(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def kinds():
    return np.frombuffer(pc.unsqueeze(bpe.classes()), np.uint8)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_encode_and_decode(spark, docs_of, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 40_000)
    monkeypatch.setattr(bpe, "BUCKET_BYTES", 50_000)
    found = bpe.decode(bpe.encode(docs_of(TEXTS), RANKS), RANKS).collect()
    expected = [(i, as_bytes(library.encode_ordinary(text or "")), (text or "").encode()) for i, text in TEXTS]
    assert by_key((r.doc_id, bytes(r.tokens), bytes(r.decoded)) for r in found) == by_key(expected)
    assert all(r.n_tokens * 4 == len(r.tokens) for r in found)


def test_no_documents(docs_of):
    assert bpe.decode(bpe.encode(docs_of([]), RANKS), RANKS).collect() == []


def test_documents_without_text(docs_of):
    found = bpe.decode(bpe.encode(docs_of([(1, None), (2, "")]), RANKS), RANKS).collect()
    assert by_key((r.doc_id, r.n_tokens, bytes(r.decoded)) for r in found) == [(1, 0, b""), (2, 0, b"")]


def test_unknown_and_null_ids_decode_to_null(spark):
    rows = [(1, as_bytes([50_256])), (2, None), (3, as_bytes([0]))]
    found = bpe.decode(spark.createDataFrame(rows, "doc_id long, tokens binary"), RANKS).collect()
    assert {r.doc_id: r.decoded for r in found} == {1: None, 2: None, 3: b"!"}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aZs'trevmld  \n\t09!-é字😀 ́\x1c\x85\0\U0001e030౜")), max_size=30), max_size=5))
def test_splits_as_the_library(library, kinds, texts):
    block = bpe._Block(kinds)
    for text in texts:
        block.add(0, text.encode())
    block.flush()
    words, places, at = list(block.number), np.concatenate(block.places), 0
    for text, count in zip(texts, block.counts):
        own = [words[i] for i in places[at : at + count]]
        at += count
        assert [i for w in own for i in bpe.merged(bpe.ranks_of(RANKS), w)] == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=120))
def test_both_ways_to_merge_agree(word):
    ranks = bpe.ranks_of(RANKS)
    if word not in ranks:
        assert bpe._merged_long(ranks, word) == bpe.merged(ranks, word)


def test_long_words_are_distinct_by_all_bytes():
    words = [b"x" * 20 + b"a", b"x" * 20 + b"b", b"x" * 15, b"x" * 16, b"x" * 8, b"x" * 7 + b"\0"] * 2
    ends = np.cumsum([len(w) for w in words])
    found, which = bpe._distinct(b"".join(words), ends - [len(w) for w in words], ends)
    assert [found[i] for i in which] == words


def test_parts_end_where_pre_tokens_do(monkeypatch):
    monkeypatch.setattr(bpe, "SPLIT_BYTES", 10)
    text = "abc def  ghi jkl\n mno 'pqr stu vwx é é é é é yz " * 3
    assert "".join(bpe.parts_of(text.encode())) == text
    assert all(part.startswith(" ") for part in bpe.parts_of(text.encode())[1:])



def test_a_word_has_one_bucket(docs_of, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 10)
    blocks = bpe.blocks(docs_of([(i, "one two three four") for i in range(50)]), 3)
    buckets = {}
    for r in bpe._exploded(blocks, 2).collect():
        for word in bpe._words_of(r.asDict()):
            buckets.setdefault(word, set()).add(r.bucket)
    assert blocks.count() >= 3 and sorted(buckets) == [b" four", b" three", b" two", b"one"]
    assert all(len(found) == 1 for found in buckets.values())


def test_blocks_are_made_and_shuffled_once(docs_of):
    encoded = bpe.encode(docs_of(TEXTS), RANKS)
    encoded.collect()
    assert "ReusedExchange" in encoded._jdf.queryExecution().executedPlan().toString()


def test_a_changed_block_is_an_error():
    held = {"ids": [1], "counts": [1], "places": pc.pack(np.zeros(1)), "sizes": pc.pack(np.ones(1)), "words": pc.squeeze(b"a")}
    sent = {"crc": [0], "numbers": [pc.pack(np.zeros(1))], "sizes": [pc.pack(np.ones(1))], "tokens": [bpe._pack_ids([64])]}
    with pytest.raises(ValueError):
        bpe._reassembled((0,), pa.table({"held": pa.array([held], bpe.HELD)}), pa.table(sent))
