"""Keyword search by BM25 over an inverted index, and the fusion of ranked lists.

The index is three tables.  ``chunks`` are numbered in chunk order, so that equal scores rank by
number.  ``postings`` has a row per word, scope and range of chunk numbers, with the chunks of
the range that hold the word and the best score the word reaches in any of them; a frequent word
is so spread over many rows, and no row grows with the table.  ``terms`` counts chunks per word.
Chunks of a range lie in one partition, so postings are made where the chunks lie; a range that a
scan has cut has a row for each part.

A search of any number of questions is one job of joins and sums.  First only the best scores are
read: their sum over a question's words bounds what a chunk of a range can reach.  The ranges with
the highest bounds are scored, which gives each question a k-th score; of the other ranges only
those are scored whose bound reaches it.  The postings of the asked words meet the questions range
by range, and a range gives at most k chunks per question.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from docspark import schemas
from docspark.functions import text as tx
from docspark.operators.search import BROADCAST_HITS, CHUNK_ORDER, SCORE_DIGITS
from docspark.operators.split import bound, word_count
from docspark.sources import staging

# Chunks of one range, at most; not over 65,536.
RANGE_CHUNKS = 4_096
# Bytes of text whose words a task counts at a time.
HELD_BYTES = 16_000_000
# Words of questions that meet a range's postings at a time, at most; mostly that is all.
ASKED_WORDS = 500_000
# Ranges that are scored to find a question's k-th score.
FIRST_RANGES = 4
# The usual constants of the formula.
K1, B = 1.2, 0.75
# Sums of bounds and of scores may differ in their last digits.
SLACK = 1e-6
# The usual constant of reciprocal rank fusion.
RRF_CONSTANT = 60


def words_of(plain: Column) -> Column:
    """Lower-cased words of a collapsed text; a blank or null one has none."""
    words = F.split(F.lower(plain), " ", -1)
    return F.when(F.length(plain) > 0, words).otherwise(F.array().cast("array<string>"))


def _term_counts(words: Column) -> Column:
    """Distinct words with their numbers: the runs of the sorted words."""

    def runs(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered)))
        new = F.filter(places, lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)))
        return bound(new, lambda starts: F.transform(starts, lambda at, nth: run(ordered, starts, at, nth)))

    def run(ordered: Column, starts: Column, at: Column, nth: Column) -> Column:
        end = F.coalesce(F.get(starts, nth + 1), F.size(ordered) + 1)
        return F.struct(F.get(ordered, at - 1).alias("term"), (end - at).alias("tf"))

    return bound(F.array_sort(words), runs)


@dataclass(frozen=True)
class Index:
    """The written tables of an index, and the numbers that scores depend on."""

    chunks: DataFrame
    postings: DataFrame
    terms: DataFrame
    n_chunks: int
    average: float
    order_by: tuple[str, ...]
    scope: str | None
    k1: float
    b: float

    def save(self, path: str) -> None:
        """Write the index; ``load`` reads it back."""
        for name in ("chunks", "postings", "terms"):
            getattr(self, name).write.parquet(f"{path}/{name}")
        self.save_numbers(path)

    def save_numbers(self, path: str) -> None:
        """Write the numbers that scores depend on."""
        row = (self.n_chunks, self.average, list(self.order_by), self.scope, self.k1, self.b)
        fields = "n_chunks LONG, average DOUBLE, order_by ARRAY<STRING>, scope STRING, k1 DOUBLE, b DOUBLE"
        self.chunks.sparkSession.createDataFrame([row], fields).coalesce(1).write.parquet(f"{path}/numbers")


def load(spark: SparkSession, path: str) -> Index:
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("chunks", "postings", "terms")}
    numbers = spark.read.parquet(f"{path}/numbers").first().asDict()
    numbers["order_by"] = tuple(numbers["order_by"])
    return Index(**tables, **numbers)


# A posting's columns behind its word and scope; for each chunk where in the range it is, how often it
# has the word, and of how many words it is, as little-endian numbers of the fewest bytes.
_NUMBERS = ("at", "tf", "size")
_KINDS = {1: np.dtype("u1"), 2: np.dtype("<u2"), 4: np.dtype("<u4")}
_POSTING = [
    T.StructField("_range", T.LongType()),
    T.StructField("best", T.DoubleType()),
    T.StructField("n_found", T.IntegerType()),
    *[T.StructField(name, T.BinaryType()) for name in _NUMBERS],
]


def _factor(tf: np.ndarray, size: np.ndarray, k1: float, b: float, average: float) -> np.ndarray:
    return tf * (k1 + 1) / (tf + k1 * ((1 - b) + b * size / (average or 1.0)))


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of numbers as one binary value each."""
    step = next(n for n in _KINDS if values.max() < 256**n)
    offsets, data = (ends * step).astype(np.int32), values.astype(_KINDS[step])
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(found: bytes, n: int) -> np.ndarray:
    return np.frombuffer(found, _KINDS[len(found) // n]).astype(np.int64)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _counter(k1: float, b: float, average: float) -> Callable:
    """The task side of the index: numbered lower-cased texts in, postings out."""
    range_chunks, held_bytes = RANGE_CHUNKS, HELD_BYTES

    def postings(held: list[pa.RecordBatch], nth: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        number, scope, text = (c.chunk(0) for c in table.columns)
        lists = pc.split_pattern(text.cast(pa.large_string()), " ")
        size = pc.list_value_length(lists).to_numpy()
        row = pc.list_parent_indices(lists).to_numpy()
        words = pc.list_flatten(lists).dictionary_encode()
        scopes = scope.dictionary_encode()
        n_scopes, n_rows = len(scopes.dictionary) + 1, len(size)
        of_row = scopes.indices.fill_null(n_scopes - 1).to_numpy().astype(np.int64)
        key = (words.indices.to_numpy().astype(np.int64) * n_scopes + of_row[row]) * n_rows + row
        key, tf = np.unique(key, return_counts=True)
        group, row = np.divmod(key, n_rows)
        first = _starts(group)
        best = np.maximum.reduceat(_factor(tf, size[row], k1, b, average), first)
        term, code = np.divmod(group[first], n_scopes)
        ends = np.append(first, len(group))
        numbers = (number.to_numpy()[row] - nth * range_chunks, tf, size[row])
        parts = [pa.array(np.diff(ends), pa.int32()), *[_packed(values, ends) for values in numbers]]
        own = scopes.dictionary.take(pa.array(code, mask=code == n_scopes - 1))
        found = [words.dictionary.cast(pa.string()).take(pa.array(term)), own, pa.array(np.full(len(first), nth, np.int64)), pa.array(best), *parts]
        return pa.RecordBatch.from_arrays(found, ["term", "_scope", *[f.name for f in _POSTING]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n_bytes, held_range = 0, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(0).to_numpy() // range_chunks
            length = pc.binary_length(batch.column(2)).to_numpy().astype(np.int64)
            # Pieces of one range and of bounded size.
            cuts = np.flatnonzero((of[1:] != of[:-1]) | (np.diff(np.cumsum(length) // held_bytes) > 0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)]):
                if held and (of[begin] != held_range or n_bytes >= held_bytes):
                    yield postings(held, held_range)
                    held, n_bytes = [], 0
                held.append(batch.slice(begin, end - begin))
                held_range = int(of[begin])
                n_bytes += int(length[begin:end].sum())
        if held:
            yield postings(held, held_range)

    return count


def build(
    chunks: DataFrame,
    *,
    text: str = "text",
    order_by: tuple[str, ...] = CHUNK_ORDER,
    scope: str | None = "year",
    k1: float = K1,
    b: float = B,
    path: str | None = None,
) -> Index:
    """Index the words of ``text``, which is a collapsed text, as chunks are.

    A chunk without text is kept and never found.  One shuffle lays the chunks out in order; words
    are counted where they lie.  With a ``path`` the tables are written there, for ``load``, and need
    no ``save``.
    """
    if k1 < 0 or not 0 <= b <= 1:
        raise ValueError("need k1 >= 0 and 0 <= b <= 1")
    at = lambda name: f"{path}/{name}" if path is not None else None
    # Laid out in chunk order, so that numbers compare as chunks do.
    laid = chunks.drop("embedding").repartitionByRange(*[F.col(c).asc_nulls_last() for c in order_by])
    laid = laid.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order_by])
    numbered = laid.withColumn("_no", F.monotonically_increasing_id())
    plain = F.col(text)
    size = F.when(F.length(plain) > 0, word_count(plain)).otherwise(0)
    seen = Observation("words")
    numbered, n_chunks = staging.stage(numbered.observe(seen, F.sum(size).alias("words")), "keyword_chunks", at("chunks"))
    average = (seen.get["words"] or 0) / max(1, n_chunks)

    value = F.col(scope) if scope is not None else F.lit(None).cast("int")
    rows = numbered.select("_no", value.alias("_scope"), F.lower(plain).alias("_text")).where(F.length("_text") > 0)
    kind = rows.schema["_scope"]
    out = T.StructType([T.StructField("term", T.StringType()), kind, *_POSTING])
    postings = rows.mapInArrow(_counter(k1, b, average), out)
    postings, _ = staging.stage(postings, "keyword_postings", at("postings"))
    terms = postings.groupBy("term").agg(F.sum("n_found").alias("n_chunks"))
    terms, _ = staging.stage(terms.sortWithinPartitions("term"), "keyword_terms", at("terms"))
    index = Index(numbered, postings, terms, n_chunks, average, tuple(order_by), scope, k1, b)
    if path is not None:
        index.save_numbers(path)
    return index


def _question_terms(index: Index, queries: DataFrame) -> DataFrame:
    """The words of every question with their weight: how often it has them, times their rarity."""
    plain = tx.collapse(F.col("query"))
    value = F.col(index.scope) if index.scope is not None else F.lit(None)
    kind = index.postings.schema["_scope"].dataType
    terms = F.inline_outer(_term_counts(words_of(plain)))
    asked = queries.select("query_id", value.cast(kind).alias("_of"), terms).where("term IS NOT NULL")
    rare = F.log(F.lit(1.0) + (F.lit(index.n_chunks) - F.col("n_chunks") + 0.5) / (F.col("n_chunks") + 0.5))
    return asked.join(index.terms, "term").select("query_id", "_of", "term", (F.col("tf") * rare).alias("weight"))


def _seen(index: Index) -> Column:
    """A question sees the chunks of its scope, all of them if it has none."""
    if index.scope is None:
        return F.lit(True)
    return F.col("_of").isNull() | (F.col("_of") == F.col("_scope"))


@dataclass(frozen=True)
class _Rule:
    """How many chunks of a range are kept per question, how they score, and blocks of questions."""

    k: int
    k1: float
    b: float
    average: float
    blocks: int


def _scored(asked: DataFrame, postings: DataFrame, ranges: DataFrame, rule: _Rule) -> DataFrame:
    """The scores (query_id, _no, score) of the k best chunks of each question in each of its given ranges.

    ``asked`` has the block of every question.  Only postings of asked words in wanted ranges move.
    """
    wanted = asked.join(ranges, "query_id")
    found = postings.join(F.broadcast(ranges.select("_range").distinct()), "_range", "left_semi")
    found = found.join(_shipped(asked.select("term").distinct(), rule), "term", "left_semi")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(rule.blocks - 1))) if rule.blocks > 1 else F.lit(0)
    found = found.select("_range", "term", "_scope", "n_found", *_NUMBERS, blocks.alias("_block"))
    out = T.StructType([asked.schema["query_id"], T.StructField("_no", T.LongType()), T.StructField("score", T.DoubleType())])
    return wanted.groupBy("_range", "_block").cogroup(found.groupBy("_range", "_block")).applyInArrow(_best_of_range(rule), out)


def _shipped(asked: DataFrame, rule: _Rule) -> DataFrame:
    """Words of questions go to every task if there is one block of them."""
    return F.broadcast(asked) if rule.blocks == 1 else asked


def _best_of_range(rule: _Rule) -> Callable:
    """The task side of a search: the questions and the postings of one range in, its best chunks out."""
    range_chunks, digits, k = RANGE_CHUNKS, SCORE_DIGITS, rule.k

    def best_of(asked: pa.Table, postings: pa.Table) -> pa.Table:
        ids = asked.column("query_id").combine_chunks().dictionary_encode()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if asked.num_rows and postings.num_rows and k:
            nth = asked.column("_range")[0].as_py()
            for q, at, score in scored(asked, ids.indices.to_numpy(), postings):
                found.append((np.full(len(at), q, np.int64), at + nth * range_chunks, score))
        q, number, score = map(np.concatenate, zip(nothing, *found))
        return pa.table({"query_id": ids.dictionary.take(pa.array(q)), "_no": number, "score": score})

    def scored(asked: pa.Table, of_query: np.ndarray, postings: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per question its best places in the range, in chunk order, and their scores."""
        ends = np.cumsum([0, *postings.column("n_found").to_pylist()])
        each = np.diff(ends).tolist()
        at, tf, size = (np.concatenate([_unpacked(x, n) for x, n in zip(postings.column(c).to_pylist(), each)]) for c in _NUMBERS)
        factor = _factor(tf, size, rule.k1, rule.b, rule.average)
        rows: dict[str, list[tuple]] = {}
        for i, (word, scope) in enumerate(zip(postings.column("term").to_pylist(), postings.column("_scope").to_pylist())):
            rows.setdefault(word, []).append((scope, at[ends[i] : ends[i + 1]], factor[ends[i] : ends[i + 1]]))
        # Words are summed in one order, so that copies of a chunk score alike in all ranges.
        terms, scopes, weights = (asked.column(c).to_pylist() for c in ("term", "_of", "weight"))
        order = sorted(range(len(terms)), key=lambda i: (of_query[i], terms[i]))
        of_query = of_query[order]
        total = np.zeros(range_chunks)
        starts = _starts(of_query).tolist()
        for begin, end in zip(starts, [*starts[1:], len(order)]):
            total[:] = 0
            for i in order[begin:end]:
                for scope, places, factors in rows.get(terms[i], ()):
                    if scopes[i] is None or scopes[i] == scope:
                        total[places] += weights[i] * factors
            hit = np.flatnonzero(total)
            score = np.round(total[hit], digits)
            if len(hit) > k:
                # All above the k-th score, then the first ones equal to it.
                kth = np.partition(score, len(hit) - k)[len(hit) - k]
                above = np.flatnonzero(score > kth)
                top = np.concatenate([above, np.flatnonzero(score == kth)[: k - len(above)]])
                hit, score = hit[top], score[top]
            yield int(of_query[begin]), hit, score

    return best_of


def _best(scored: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "_no"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(index: Index, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best chunks of every question (query_id, query and, with a scope, its column).

    The result has ``query_id``, ``rank``, the chunk columns and ``score``.  Each word of a question
    counts as often as it stands there.  Chunks without any of its words are no hits; equal
    scores rank in chunk order.  Statistics are those of the whole index, so scores compare across
    scopes; a null scope sees all chunks.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    asked, n_asked = staging.stage(_question_terms(index, queries), "question_terms")
    rule = _Rule(k, index.k1, index.b, index.average, max(1, -(-n_asked // ASKED_WORDS)))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(rule.blocks)).cast("int"))
    bounds = _shipped(asked, rule).join(index.postings.select("term", "_scope", "_range", "best"), "term").where(_seen(index))
    # A range at the border of two scopes has a row for each.
    bounds = bounds.groupBy("query_id", "_range", "term", "weight").agg(F.max("best").alias("best"))
    bounds = bounds.groupBy("query_id", "_range").agg(F.sum(F.col("weight") * F.col("best")).alias("bound"))
    bounds, _ = staging.stage(bounds, "range_bounds")

    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "_range")
    first = bounds.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= FIRST_RANGES)
    early = _best(_scored(asked, index.postings, first.select("query_id", "_range"), rule), k)
    early, _ = staging.stage(early, "early_hits")
    floor = early.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    # Ranges below the k-th score cannot change the result.
    rest = bounds.join(first.select("query_id", "_range"), ["query_id", "_range"], "left_anti")
    rest = rest.join(floor, "query_id", "left").where(F.col("floor").isNull() | (F.col("bound") + SLACK >= F.col("floor")))
    late = _best(_scored(asked, index.postings, rest.select("query_id", "_range"), rule), k)
    hits = _best(early.drop("rank").unionByName(late.drop("rank")), k)
    # Numbers and scores only; the texts of the index are not shuffled for few hits.
    hits, n_hits = staging.stage(hits, "hits")
    hits = F.broadcast(hits) if n_hits <= BROADCAST_HITS else hits
    return hits.join(index.chunks, "_no").drop("_no")


def search(index: Index, queries: DataFrame, k: int = 5, *, preview_chars: int = 200) -> DataFrame:
    """Answer a table of questions by keywords; the score is in ``similarity_score``."""
    hits = top_k(index, queries, k).withColumnRenamed("score", "similarity_score")
    hits = hits.withColumn("chunk", tx.preview(F.col("text"), preview_chars))
    return hits.withColumnRenamed("text", "full_text").select(*schemas.SEARCH_HIT.names)


def fuse(
    lists: list[DataFrame],
    k: int = 5,
    *,
    how: str = "rrf",
    weights: list[float] | None = None,
    constant: int = RRF_CONSTANT,
    key: tuple[str, ...] = ("chunk_id",),
    score: str = "similarity_score",
    order_by: tuple[str, ...] = ("chunk_id",),
) -> DataFrame:
    """Fuse ranked lists of hits (query_id, rank, key, score, …) into the ``k`` best of each question.

    ``rrf`` adds weight / (constant + rank).  ``minmax`` adds weight times the score scaled to 0 to 1
    within the question's list; a list of equal scores counts 1.  A hit that a list does
    not have gets nothing from it.  Equal results rank in ``order_by`` order, nulls last.  The other
    columns are those of the first list that has the hit.  The result has the fused score in the
    ``score`` column, rounded to nine digits.
    """
    if how not in ("rrf", "minmax"):
        raise ValueError("how is rrf or minmax")
    weights = weights if weights is not None else [1.0] * len(lists)
    if len(weights) != len(lists) or not lists:
        raise ValueError("one weight per list is needed")
    columns = lists[0].columns
    others = [c for c in columns if c not in ("query_id", "rank", score, *key)]

    def part(hits: DataFrame, weight: float, nth: int) -> DataFrame:
        if how == "rrf":
            gain = F.lit(1.0) / (F.lit(constant) + F.col("rank"))
        else:
            own = Window.partitionBy("query_id")
            low, high = F.min(score).over(own), F.max(score).over(own)
            gain = F.coalesce(F.try_divide(F.col(score) - low, high - low), F.lit(1.0))
        return hits.select("query_id", *key, (gain * weight).alias("_gain"), F.struct(F.lit(nth).alias("_nth"), *others).alias("_row"))

    parts = [part(hits, weight, nth) for nth, (hits, weight) in enumerate(zip(lists, weights))]
    every = reduce(DataFrame.unionByName, parts)
    fused = every.groupBy("query_id", *key).agg(
        F.round(F.sum("_gain"), SCORE_DIGITS).alias(score), F.min_by("_row", "_row._nth").alias("_row")
    )
    fused = fused.select("query_id", *key, score, *[F.col("_row")[c].alias(c) for c in others])
    order = [F.desc(score), *[F.col(c).asc_nulls_last() for c in order_by]]
    fused = fused.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast(T.IntegerType()))
    return fused.where(F.col("rank") <= k).select(*columns)
