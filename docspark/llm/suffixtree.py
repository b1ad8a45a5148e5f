"""Language model scoring with a probabilistic suffix tree.

A text is the sequence of its tokens: words, with A-Z in lower case, and one end.  Written with
single spaces between words that is a string of bytes, whose end is one more symbol.  The tree
holds contexts of up to ``depth`` bytes.  A context is retained if the distribution of its
next symbol diverges enough from that of the context one byte shorter, weighted by how often
it was seen, or if a longer retained context ends in it.  Distributions are smoothed with that
of the shorter context, down to add-one counts of single symbols.  Every symbol of a text is
scored in the longest retained context that ends before it.

Counts cover all training documents, and every context that passes the test is retained; the
states are a written table and never meet in one place.  The chance of each context and symbol
that the documents hold is made level by level from that table, and goes back in buckets to the
pieces of documents that asked for it (see ``pieces``), like the word counts of the base score.

Defined results: a null text is empty and has one token, its end; a null id belongs to the
training part; without training documents all counts are zero and every symbol is equally
likely; repeated rows are counted and scored each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docspark.llm import pieces as pc
from docspark.llm import words as wd
from docspark.sources import staging

FOLDS = 7
HELD_OUT = 2
# A word holds no line break, so this byte can stand for the end and the time before a text.
END = b"\n"
SYMBOLS = 256
# Symbols with their contexts are dealt to this many buckets at least, spread by a prime.
GRAM_BUCKETS = 512
SPREAD = 1_000_003


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def _strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts as ``depth`` bytes of context and one symbol, and their texts.

    Each is a number whose lowest byte is the symbol.
    """
    joined = [END * depth + b" ".join(text.lower().split()) + END for text in texts]
    data = np.frombuffer(b"".join(joined), np.uint8)
    sizes = np.array(list(map(len, joined)), np.int64)
    value = np.zeros(max(0, len(data) - depth), np.int64)
    for k in range(depth + 1):
        value <<= 8
        value |= data[k : k + len(value)]
    begin = np.cumsum(sizes) - sizes
    real = np.ones(len(value), bool)
    for k in range(1, depth + 1):  # windows that run over the edge of two texts
        at = begin[1:] - k
        real[at[at >= 0]] = False
    return value[real], np.cumsum(sizes - depth) - (sizes - depth)


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about one slice."""
    at = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= wd.SLICE_BYTES:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _distinct(texts: list[bytes], depth: int) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray]:
    """Of each run of texts the symbols as codes, their values and texts; and all values, ascending."""
    runs, seen = [], [np.zeros(0, np.int64)]
    for a, b in _runs(texts):
        grams, begin = _strings(texts[a:b], depth)
        codes, unique = pd.factorize(grams)
        runs.append((codes.astype(np.int32), unique, begin))
        seen.append(unique)
    return runs, np.unique(np.concatenate(seen))


def _in_buckets(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by bucket and value, and the bucket of each."""
    bucket = grams % SPREAD % buckets
    return np.lexsort((grams, bucket)), bucket


def _gram_rows(depth: int, buckets: int):
    """What each piece asks: its contexts and symbols of full depth, and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece = pc.open_piece(batch, i)
                trains = np.array([not held_out(d) for d in piece.ids.to_pylist()], bool)
                runs, grams = _distinct(piece.texts.to_pylist(), depth)
                total, at = np.zeros(len(grams), np.int64), 0
                for codes, unique, begin in runs:
                    weights = np.repeat(trains[at : at + len(begin)], np.diff(begin, append=len(codes)))
                    total[np.searchsorted(grams, unique)] += np.bincount(codes, weights, len(unique)).astype(np.int64)
                    at += len(begin)
                order, bucket = _in_buckets(grams, buckets)
                grams, total, bucket = grams[order], total[order], bucket[order]
                edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
                parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([bucket[p.start] for p in parts], pa.int32()),
                        "piece": pa.array([batch.column("piece")[i].as_py()] * len(parts), pa.int64()),
                        "grams": pa.array([pc.pack_sorted(grams[p]) for p in parts], pa.binary()),
                        "counts": pa.array([pc.pack(total[p]) for p in parts], pa.binary()),
                    }
                )

    return run


def _sum_grams(group: pa.Table) -> pa.Table:
    """How often each context and symbol of a bucket comes in the training documents."""
    grams = np.concatenate([pc.unpack_sorted(g.as_py()) for g in group.column("grams")]).astype(np.int64)
    counts = np.concatenate([pc.unpack(c.as_py()) for c in group.column("counts")]).astype(np.int64)
    unique, at = np.unique(grams, return_inverse=True)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, at, counts)
    return pa.table({"gram": pa.array(unique), "n": pa.array(total)})


@dataclass
class Tree:
    """Retained contexts by length, in memory: the model of ``chances`` for a few of them.

    A level has ascending contexts, how often each was seen, how many different symbols came
    next, and the ascending (context, symbol) pairs with their counts.
    """

    levels: list[tuple[np.ndarray, ...]]
    depth: int

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the symbol of each (context, symbol) of full depth."""
        symbol, context = grams & 255, grams >> 8
        chance = np.full(len(grams), 1 / SYMBOLS)
        open_ = np.ones(len(grams), bool)
        for k, (contexts, totals, kinds, pairs, counts) in enumerate(self.levels):
            if not len(contexts):
                break
            own = context & ((1 << (8 * k)) - 1)
            at = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            open_ &= contexts[at] == own
            pair = own << 8 | symbol
            where = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            n = np.where(pairs[where] == pair, counts[where], 0)
            # Add-one counts without a context; above, the shorter context weighs as much as
            # new symbols were met.
            weight = SYMBOLS if k == 0 else kinds[at]
            chance = np.where(open_, (n + weight * chance) / (totals[at] + weight), chance)
        return np.log10(chance)


def _last(value: str, count: Column, depth: int) -> Column:
    """The last ``count`` bytes of a number."""
    masks = F.array(*[F.lit((1 << (8 * n)) - 1).cast("long") for n in range(depth + 2)])
    return F.col(value).bitwiseAND(F.get(masks, count))


def grow(grams: DataFrame, depth: int, min_count: int, min_divergence: float) -> DataFrame:
    """Count and test all contexts; the retained ones are the states of the tree.

    Of every context and symbol (k, pair), from none to full depth, how often it was seen (n);
    and of its context, where that is retained, how often it was seen (total) and how many
    different symbols came next (kinds).
    """
    lengths = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("k")
    # Counts of every context, from none to full depth, with the symbol after it.
    pairs = grams.select(lengths, "gram", "n").select("k", _last("gram", F.col("k") + 1, depth).alias("pair"), "n")
    levels, _ = staging.stage(pairs.groupBy("k", "pair").agg(F.sum("n").alias("n")), "levels")

    context = F.shiftright("pair", 8).alias("context")
    trained = levels.where("n > 0")  # other documents may hold pairs that training never met
    shorter = trained.select((F.col("k") + 1).alias("k"), F.col("pair").alias("short"), F.col("n").alias("m"))
    both = trained.withColumn("short", _last("pair", F.col("k"), depth)).join(shorter, ["k", "short"])
    # sum of n * log((n / N) / (m / M)) over symbols; M, the shorter context's count, follows.
    made = both.groupBy("k", context).agg(
        F.sum("n").alias("total"), F.sum(F.col("n") * F.log(F.col("n") / F.col("m"))).alias("logs")
    )
    made = made.where(F.col("total") >= min_count).withColumn("short", _last("context", F.col("k") - 1, depth))
    sums = trained.groupBy("k", context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    above = sums.select((F.col("k") + 1).alias("k"), F.col("context").alias("short"), F.col("total").alias("short_total"))
    made = made.join(above, ["k", "short"])
    divergence = F.col("logs") + F.col("total") * F.log(F.col("short_total") / F.col("total"))
    tested = made.where(divergence >= min_divergence).select("k", "context")
    # With every retained context, the shorter ones that it ends in: at most depth times as many.
    ends = F.explode(F.sequence(F.lit(1), F.col("k"))).alias("k")
    kept = tested.select("context", ends).select("k", _last("context", F.col("k"), depth).alias("context")).distinct()
    root = grams.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit(0).cast("long").alias("context"))
    states = sums.join(kept.union(root), ["k", "context"])
    states = levels.withColumn("context", context).join(states, ["k", "context"], "left")
    return staging.stage(states.select("k", "pair", "n", "total", "kinds"), "states")[0]


def chances(states: DataFrame, depth: int) -> DataFrame:
    """The chance of the symbol of each (context, symbol) of full depth: (gram, chance)."""
    made = None
    for k in range(depth + 1):
        own = states.where(F.col("k") == k).drop("k")
        if made is None:
            own = own.withColumn("before", F.lit(1 / SYMBOLS)).withColumn("kinds", F.lit(SYMBOLS))
        else:
            shorter = made.select(F.col("pair").alias("short"), F.col("chance").alias("before"))
            own = own.withColumn("short", _last("pair", F.lit(k), depth)).join(shorter, "short")
        # Add-one counts without a context; above, the shorter context weighs as much as new
        # symbols were met.
        mixed = (F.col("n") + F.col("kinds") * F.col("before")) / (F.col("total") + F.col("kinds"))
        chance = F.when(F.col("total").isNull(), F.col("before")).otherwise(mixed)
        made = own.select("pair", chance.alias("chance"))
    return made.select(F.col("pair").alias("gram"), "chance")


def _answer(asked: pa.Table, made: pa.Table) -> pa.Table:
    """The log chances of what each piece asked of a bucket."""
    grams = made.column("gram").to_numpy()
    order = np.argsort(grams)
    grams, logs = grams[order], np.log10(made.column("chance").to_numpy()[order])
    keys = [pc.unpack_sorted(g.as_py()).astype(np.int64) for g in asked.column("grams")]
    found = [pc.pack(logs[np.searchsorted(grams, k)].view(np.uint64)) for k in keys]
    return pa.table({"piece": asked.column("piece"), "bucket": asked.column("bucket"), "logs": pa.array(found, pa.binary())})


def _word_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece = pc.open_piece(batch, i)
                h, first = piece.hashes(lower=True)
                trains = np.array([not held_out(d) for d in piece.ids.to_pylist()], bool)
                keys, at = np.unique(h, return_inverse=True)
                counts = np.bincount(at, np.repeat(trains, np.diff(first)), len(keys)).astype(np.int64)
                rows = [
                    (bucket, pc.pack_sorted(keys[part]), pc.pack(counts[part])) for bucket, part in pc.buckets(keys, bits)
                ]
                columns = list(zip(*rows)) or [[]] * 3
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(columns[0], pa.int32()),
                        "piece": pa.array([batch.column("piece")[i].as_py()] * len(rows), pa.int64()),
                        "keys": pa.array(columns[1], pa.binary()),
                        "counts": pa.array(columns[2], pa.binary()),
                    }
                )

    return run


def _sum_words(group: pa.Table) -> pa.Table:
    """The corpus counts of the words of each piece, and what the bucket adds to N and V."""
    keys = [pc.unpack_sorted(k.as_py()) for k in group.column("keys")]
    counts = [pc.unpack(c.as_py()).astype(np.int64) for c in group.column("counts")]
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    edges = np.cumsum([0, *map(len, keys)])
    found = [pc.pack(total[at[a:b]]) for a, b in zip(edges, edges[1:])]
    n = group.num_rows
    return pa.table(
        {
            "piece": group.column("piece"),
            "bucket": group.column("bucket"),
            "counts": pa.array(found, pa.binary()),
            "tokens": pa.array([int(total.sum())] + [0] * (n - 1), pa.int64()),
            "words": pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64()),
        }
    )


def score(
    docs: DataFrame,
    depth: int = 5,
    min_count: int = 4,
    min_divergence: float = 4.0,
) -> DataFrame:
    """Base and model scores of every document (doc_id, text)."""
    packed, total = pc.cut(docs)
    bits = pc.bucket_bits(total)
    buckets = max(GRAM_BUCKETS, 1 << bits)
    rows = packed.mapInArrow(_gram_rows(depth, buckets), "bucket int, piece long, grams binary, counts binary")
    wanted, _ = staging.stage(rows, "grams")
    grams = wanted.groupBy("bucket").applyInArrow(_sum_grams, "gram long, n long")
    made = chances(grow(grams, depth, min_count, min_divergence), depth)
    made = made.withColumn("bucket", (F.col("gram") % SPREAD % buckets).cast("int"))
    answers = wanted.select("bucket", "piece", "grams").groupBy("bucket").cogroup(made.groupBy("bucket"))
    answers = answers.applyInArrow(_answer, "piece long, bucket int, logs binary")
    asked = packed.mapInArrow(_word_rows(bits), "bucket int, piece long, keys binary, counts binary")
    schema = "piece long, bucket int, counts binary, tokens long, words long"
    known, _ = staging.stage(asked.groupBy("bucket").applyInArrow(_sum_words, schema), "known")
    trains = F.aggregate(
        "ids",
        F.lit(0).cast("long"),
        lambda n, d: n + F.when(F.pmod(F.crc32(d.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, 0).otherwise(1),
    )
    ends = packed.agg(F.sum(trains)).first()[0] or 0
    sums = known.agg(F.sum("tokens"), F.sum("words")).first()
    n, v = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)

    def answered(right: pa.Table, name: str) -> np.ndarray:
        """What came back to a piece, in the order of its buckets."""
        parts = zip(right.column("bucket").to_pylist(), right.column(name).to_pylist())
        parts = sorted((p for p in parts if p[1] is not None), key=lambda p: p[0])
        return np.concatenate([np.zeros(0, np.uint64), *[pc.unpack(p) for _, p in parts]])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        counts = answered(right, "counts").astype(np.int64)
        for i in range(left.num_rows):
            piece = pc.open_piece(left, i)
            h, first = piece.hashes(lower=True)
            _, at = np.unique(h, return_inverse=True)
            c = counts[at]
            tokens = np.diff(first) + 1
            owner = np.repeat(np.arange(len(tokens)), np.diff(first))
            base = np.bincount(owner, np.log10((c + 1) / (n + v + 1)), len(tokens)).astype(np.float64)
            base += np.log10((ends + 1) / (n + v + 1))
            texts = piece.texts.to_pylist()
            runs, grams = _distinct(texts, depth)
            logs = np.zeros(len(grams))
            logs[_in_buckets(grams, buckets)[0]] = answered(right, "logs").view(np.float64)
            values = [
                np.add.reduceat(logs[np.searchsorted(grams, unique)][codes], begin) for codes, unique, begin in runs
            ]
            tables.append(
                pa.table(
                    {
                        "doc_id": piece.ids,
                        "held_out": pa.array([held_out(d) for d in piece.ids.to_pylist()], pa.bool_()),
                        "n_tokens": pa.array(tokens, pa.int64()),
                        "n_known": pa.array(wd.per_doc(first, c > 0) + (ends > 0), pa.int64()),
                        "train_tokens": pa.array([n] * len(texts), pa.int64()),
                        "base_score": pa.array(base, pa.float64()),
                        "score": pa.array(np.concatenate(values), pa.float64()),
                    }
                )
            )
        return pa.concat_tables(tables)

    out = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    back = known.select("piece", "bucket", "counts").unionByName(answers, allowMissingColumns=True)
    both = packed.groupBy("piece").cogroup(back.groupBy("piece"))
    return both.applyInArrow(run, out)
