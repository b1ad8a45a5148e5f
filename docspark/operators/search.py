"""Exact cosine top-k of many queries in one pass over the chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from docspark import schemas
from docspark.functions import text as tx
from docspark.operators.embed import Encoder, embed
from docspark.sources.staging import stage

# Chunk order, which decides between equal scores.
CHUNK_ORDER = ("filename", "section_pos", "chunk_index")
# Scores are compared at this precision, so float noise cannot reorder equal chunks.
SCORE_DIGITS = 9
# The stated queries go to every task in blocks of at most this many vector values (400 MB).
QUERY_VALUES = 50_000_000
# A task scores its chunks against this many queries at a time.
QUERY_TILE = 4_096
# Chunk × query scores that a task holds at a time.
TILE_SCORES = 2_000_000
# Partial results are merged in this many groups per query before the last ranking.
MERGE_GROUPS = 64
# So many hits, which are keys and scores only, may be broadcast to fetch their chunks.
BROADCAST_HITS = 500_000


def top_k(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    order_by: tuple[str, ...] = CHUNK_ORDER,
    scope: str | None = "year",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` best chunks of every query by cosine similarity.

    ``queries`` has ``query_id``, ``embedding`` and, unless ``scope`` is None, the scope
    column: a query sees the chunks with the same value, or all of them if its value is
    null.  The result has ``query_id``, ``rank``, ``similarity_score`` and every chunk
    column but the embedding.  Equal scores rank in ``order_by`` order; ``k`` of 0 gives no
    rows.

    Chunks and queries without an embedding, or with a component that is null, infinite or
    not a number, are left out.

    The queries are taken in blocks of ``QUERY_VALUES``; mostly there is one.  Each task
    multiplies its Arrow batches with a block's matrix, some queries at a time, and keeps a
    running top k of keys and scores.  Only those are shuffled and ranked; the columns of the
    winners come from one last join with the chunks, which does not read the embeddings.
    Further blocks are further passes over the same chunks, so write those first if there are
    many questions.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    carried = [c for c in chunks.columns if c != embedding]
    # Names the chunk; equal chunks are interchangeable.
    chunk = F.struct(*order_by, F.xxhash64(*carried).alias("_row"))
    keys = [*order_by, *([scope] if scope is not None and scope not in order_by else [])]
    kinds = {f.name: f for f in chunks.schema.fields} | {"_row": T.StructField("_row", T.LongType())}
    out = T.StructType(
        [
            T.StructField("_q", T.LongType()),
            *[kinds[c] for c in (*order_by, "_row")],
            T.StructField("similarity_score", T.DoubleType()),
        ]
    )
    order = [F.desc("similarity_score"), *[F.col(c).asc_nulls_last() for c in (*order_by, "_row")]]
    group = F.spark_partition_id() % MERGE_GROUPS
    id_field = queries.schema["query_id"]
    named = T.StructType([T.StructField("_q", T.LongType()), id_field])

    def best_of(ids: list, matrix: np.ndarray, scopes: list, first: int) -> tuple[DataFrame, DataFrame]:
        """The best keys of a block of queries, numbered from ``first``, and their ids."""
        seen = chunks
        if scope is not None and None not in scopes:
            seen = seen.where(F.col(scope).isin(sorted(set(scopes))))
        if k == 0 or not len(matrix):
            seen = seen.where(F.lit(False))
        narrow = seen.select(*keys, F.xxhash64(*carried).alias("_row"), embedding)
        shipped = chunks.sparkSession.sparkContext.broadcast((matrix, scopes))
        scored = narrow.mapInArrow(_scorer(shipped, k, list(order_by), scope, embedding), out)
        merged = _best(scored.withColumn("_group", group), ["_q", "_group"], order, k)
        ranked = _best(merged.drop("_group"), ["_q"], order, k).withColumn("_q", F.col("_q") + first)
        names = chunks.sparkSession.createDataFrame(list(enumerate(ids, first)), named)
        return ranked.select("_q", "rank", "similarity_score", F.struct(*order_by, "_row").alias("_chunk")), names

    hits = names = None
    n_queries = 0
    for (ids, matrix, scopes), last in _blocks(queries, scope):
        part, own = best_of(ids, matrix, scopes, n_queries)
        n_queries += len(ids)
        if not last or hits is not None:
            # A block's matrix leaves memory when its hits are written.
            part, own = stage(part, "block_hits")[0], stage(own, "block_ids")[0]
        hits = part if hits is None else hits.unionByName(part)
        names = own if names is None else names.unionByName(own)
    if n_queries * k <= BROADCAST_HITS:
        hits, names = F.broadcast(hits), F.broadcast(names)
    found = chunks.select(*carried, chunk.alias("_own")).join(
        hits, F.col("_own").eqNullSafe(F.col("_chunk"))
    )
    # Equal chunks match each other's hits; every hit has one row.
    found = found.dropDuplicates(["_q", "rank"])
    return found.join(names, "_q").select("query_id", "rank", *carried, "similarity_score")


def _blocks(queries: DataFrame, scope: str | None) -> Iterator[tuple[tuple[list, np.ndarray, list], bool]]:
    """Ids, vectors and scopes of the queries whose vectors are whole, in blocks, and whether it is the last."""
    value = F.col(scope) if scope is not None else F.lit(None).cast("int")
    stated = queries.select("query_id", value.alias("scope"), F.col("embedding").cast("array<double>").alias("v"))
    rows: list[tuple] = []
    held = 0
    for row in stated.where("v IS NOT NULL").toLocalIterator():
        if not all(x is not None and np.isfinite(x) for x in row.v):
            continue
        if rows and held + len(row.v) > QUERY_VALUES:
            yield _block(rows), False
            rows, held = [], 0
        held += len(row.v)
        rows.append((row.query_id, row.scope, np.array(row.v)))
    yield _block(rows), True


def _block(rows: list[tuple]) -> tuple[list, np.ndarray, list]:
    matrix = np.array([r[2] for r in rows]) if rows else np.zeros((0, 0))
    return [r[0] for r in rows], matrix, [r[1] for r in rows]


def _best(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; a zero row stays.  Scaled first, so that squares don't overflow."""
    rows = rows / np.maximum(np.abs(rows).max(axis=1, initial=0, keepdims=True), np.finfo(float).tiny)
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _first_k(q: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first k rows of each query; ``q`` is sorted."""
    start = np.concatenate([[True], q[1:] != q[:-1]])
    first = np.maximum.accumulate(np.where(start, np.arange(len(q)), 0))
    return np.arange(len(q)) - first < k


def _scorer(shipped, k: int, order_by: list[str], scope: str | None, embedding: str):
    """The task side: batches of chunks in, the task's k best keys per query out."""
    digits, tile_scores, query_tile = SCORE_DIGITS, TILE_SCORES, QUERY_TILE
    chunk_order = [(c, "ascending") for c in (*order_by, "_row")]
    sort_keys = [("_q", "ascending"), ("similarity_score", "descending"), *chunk_order]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, query_scope = shipped.value
        n_queries = len(matrix)
        if n_queries == 0:
            return
        matrix = _unit(matrix)
        of_scope: dict = {}
        for i, value in enumerate(query_scope):
            of_scope.setdefault(value, []).append(i)
        every = np.array(of_scope.pop(None, []), np.int64)
        by_scope = {
            value: np.sort(np.concatenate([every, np.array(own, np.int64)]))
            for value, own in of_scope.items()
        }
        # The k-th best score of each query so far: nothing below it can win.
        floor = np.full(n_queries, -np.inf)
        kept: list[pa.Table] = []
        n_kept = 0

        def shrink(table: pa.Table) -> pa.Table:
            table = table.take(pc.sort_indices(table, sort_keys=sort_keys))
            q = table.column("_q").to_numpy()
            table = table.filter(pa.array(_first_k(q, k)))
            q, value = table.column("_q").to_numpy(), table.column("similarity_score").to_numpy()
            last = np.flatnonzero(np.append(q[1:] != q[:-1], True))
            full = last[np.diff(last, prepend=-1) == k]
            floor[q[full]] = value[full]
            return table

        def rows_of(batch: pa.RecordBatch, ordered: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Pairs (rows in chunk order, the queries that see them)."""
            if scope is None:
                yield ordered, np.arange(n_queries)
                return
            codes = batch.column(scope).dictionary_encode()
            code = codes.indices.fill_null(-1).to_numpy()[ordered]
            values = [*codes.dictionary.to_pylist(), None]
            for c in np.unique(code):
                seeing = by_scope.get(values[c], every)
                if len(seeing):
                    yield ordered[code == c], seeing

        def best_of(vectors: np.ndarray, rows: np.ndarray, seeing: np.ndarray):
            """The scores of one tile that may win: (row, query, score)."""
            block = vectors[rows] @ matrix[seeing].T
            # Only the few columns that may win are rounded; rounding moves a score by less than its last digit.
            for j in np.flatnonzero(block.max(axis=0) >= floor[seeing] - 10.0**-digits):
                column = np.round(block[:, j], digits) + 0.0
                top = np.flatnonzero(column >= floor[seeing[j]])
                if not len(top):
                    continue
                if len(top) > k:
                    # All above the k-th score, then the first ones equal to it.
                    kth = np.partition(column[top], len(top) - k)[len(top) - k]
                    above = top[column[top] > kth]
                    equal = top[column[top] == kth][: k - len(above)]
                    top = np.concatenate([above, equal])
                yield rows[top], np.full(len(top), seeing[j], np.int64), column[top]

        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(embedding)))
            vectors = batch.column(embedding)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            if len(flat) != batch.num_rows * matrix.shape[1]:
                raise ValueError("chunk and query embeddings differ in length")
            vectors = flat.reshape(batch.num_rows, matrix.shape[1]).astype(np.float64)
            whole = np.isfinite(vectors).all(axis=1)
            if not whole.any():
                continue
            batch, vectors = batch.filter(pa.array(whole)), _unit(vectors[whole])
            ordered = pc.sort_indices(batch, sort_keys=chunk_order).to_numpy()
            found = []
            for rows, seeing in rows_of(batch, ordered):
                for first in range(0, len(seeing), query_tile):
                    part = seeing[first : first + query_tile]
                    step = max(1, tile_scores // len(part))
                    for begin in range(0, len(rows), step):
                        found += best_of(vectors, rows[begin : begin + step], part)
            if not found:
                continue
            row, q, value = map(np.concatenate, zip(*found))
            place = np.empty(len(ordered), np.int64)
            place[ordered] = np.arange(len(ordered))
            top = np.lexsort((place[row], -value, q))
            top = top[_first_k(q[top], k)]
            table = pa.Table.from_batches([batch]).select([*order_by, "_row"]).take(pa.array(row[top]))
            table = table.add_column(0, "_q", pa.array(q[top]))
            kept.append(table.append_column("similarity_score", pa.array(value[top])))
            n_kept += table.num_rows
            if n_kept > 2 * k * n_queries or not np.isfinite(floor).all():
                kept = [shrink(pa.concat_tables(kept))]
                n_kept = kept[0].num_rows
        if kept:
            yield from shrink(pa.concat_tables(kept)).to_batches()

    return score


def embed_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """The encoder applied to the query text, white space collapsed as in chunks.

    Chunks are joined by single blanks; a question in the same form gets the vector that the
    same words have in a chunk.
    """
    plain = queries.withColumn("_plain", tx.collapse(F.col("query")))
    return embed(plain, encoder, "_plain").drop("_plain")


def search(
    chunks: DataFrame,
    queries: DataFrame,
    encoder: Encoder,
    k: int = 5,
    *,
    preview_chars: int = 200,
) -> DataFrame:
    """Answer a table of questions, each within its year.

    ``chunks`` are embedded wide chunks, ``queries`` have ``query_id, query, year``.  A
    year without chunks gives no rows.
    """
    hits = top_k(chunks, embed_queries(queries, encoder), k)
    hits = hits.withColumn("chunk", tx.preview(F.col("text"), preview_chars))
    return hits.withColumnRenamed("text", "full_text").select(*schemas.SEARCH_HIT.names)


def search_one(
    chunks: DataFrame,
    query: str,
    year: int,
    encoder: Encoder,
    k: int = 5,
    *,
    preview_chars: int = 200,
) -> DataFrame:
    """Answer one question."""
    queries = chunks.sparkSession.createDataFrame([(1, query, year)], schemas.QUERY)
    return search(chunks, queries, encoder, k, preview_chars=preview_chars)
