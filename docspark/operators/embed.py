"""Batch inference: a text column becomes an ``array<float>`` column."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

# Words whose buckets a task remembers (about 20 MB).
KNOWN_WORDS = 100_000
# Texts whose words a task counts at a time.
COUNTED_TEXTS = 1_024

Model = Callable[[list[str]], np.ndarray]


@dataclass(frozen=True)
class Encoder:
    """How to turn texts into vectors.

    ``load`` runs once per task and returns a function from a list of texts to an
    (n, dim) array; ``batch_size`` is the number of texts per call.
    """

    load: Callable[[], Model]
    batch_size: int = 32


def hash_bow(dim: int = 64) -> Encoder:
    """A deterministic encoder that needs no model.

    Lower-cased words are counted in ``dim`` buckets, the first 24 bits of the word's
    MD5 modulo ``dim``, and the counts are scaled to unit length.  Words are what single
    blanks separate, as in chunks.
    """

    def load() -> Model:
        buckets: dict[str, int] = {}

        def bucket(word: str) -> int:
            found = buckets.get(word)
            if found is None:
                if len(buckets) >= KNOWN_WORDS:
                    buckets.clear()
                digest = hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()
                found = buckets[word] = int(digest[:6], 16) % dim
            return found

        def encode(texts: list[str]) -> np.ndarray:
            parts = [count(texts[i : i + COUNTED_TEXTS]) for i in range(0, len(texts), COUNTED_TEXTS)]
            return np.concatenate(parts) if parts else np.zeros((0, dim), np.float32)

        def count(texts: list[str]) -> np.ndarray:
            lists = pc.split_pattern(pc.utf8_lower(pa.array(texts, pa.large_string())), " ")
            words = pc.list_flatten(lists).dictionary_encode()
            of_word = np.array([bucket(w) for w in words.dictionary.to_pylist()], np.int64)
            row = pc.list_parent_indices(lists).to_numpy()
            cell = row * dim + of_word[words.indices.to_numpy()]
            counts = np.bincount(cell, minlength=len(texts) * dim).reshape(-1, dim)
            length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            return (counts / np.maximum(length, 1)).astype(np.float32)

        return encode

    return Encoder(load, batch_size=4096)


def embed(
    df: DataFrame, encoder: Encoder, text: str = "chunk_text", into: str = "embedding"
) -> DataFrame:
    """Add the embedding of ``text``; a null text has a null embedding.

    Arrow batches in and out, the model is loaded once per task.  The column is an
    ordinary expression: a plan that does not read it never starts a Python worker.
    """
    load, size = encoder.load, encoder.batch_size

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for batch in batches:
            present = pc.is_valid(batch).to_numpy(zero_copy_only=False)
            texts = batch.drop_null()
            # Python strings of one call at a time.
            parts = [
                np.asarray(model(texts.slice(i, size).to_pylist()), np.float32)
                for i in range(0, len(texts), size)
            ]
            matrix = np.concatenate(parts) if parts else np.zeros((0, 1), np.float32)
            ends = np.cumsum(present) * matrix.shape[1]
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.ListArray.from_arrays(
                offsets, pa.array(matrix.ravel()), mask=pa.array(~present)
            )

    return df.withColumn(into, vectors(F.col(text)))


def with_vector(
    df: DataFrame, embedding: str = "embedding", into: str = "embedding_vector"
) -> DataFrame:
    """Add the embedding as an ML vector."""
    return df.withColumn(into, array_to_vector(F.col(embedding)))
