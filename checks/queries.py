"""One Spark query per operator; all read the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from docspark.functions import vectors as v
from docspark.operators import choose, chunk, cluster, evaluate, keyword, plots, profile, refine, search, select, split
from docspark.operators.embed import Encoder, embed, hash_bow, with_vector
from docspark.operators.sections import extract_sections
from docspark.plans.explore import Exploration, explore, write_plots
from docspark.plans.prepare import prepare
from docspark.plans.retrieve import ask, index_chunks, retrieve
from docspark.sources import filings as src, staging

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(column: str, digits: int) -> F.Column:
    """Adding zero turns a negative zero into zero."""
    return (F.round(F.col(column).cast("double"), digits) + F.lit(0.0)).alias(column)


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return src.missing_to_null(fx.filings_wide(spark, sf))


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "embeddings")


# Selection and profiles


@query
def select_companies(spark, sf):
    return select.select_companies(fx.filings_raw(spark, sf), 5)


@query
def select_company_list(spark, sf):
    return select.select_companies(fx.filings_raw(spark, sf), ciks=["src3", "src12", "none"])


@query
def filter_cik_years(spark, sf):
    return prepare(wide(spark, sf), cik="src3", years=[2018, 2020]).filings


@query
def filter_year(spark, sf):
    return select.in_year(fx.filings_raw(spark, sf), 2020)


@query
def first_per_year(spark, sf):
    return select.first_per_year(wide(spark, sf))


@query
def corpus_shape(spark, sf):
    return profile.corpus_shape(wide(spark, sf))


@query
def corpus_values(spark, sf):
    return profile.corpus_values(wide(spark, sf))


@query
def section_profile(spark, sf):
    return profile.section_profile(wide(spark, sf))


@query
def csv_round_trip(spark, sf):
    path = staging.new_folder(spark, "filings_csv")
    src.write_csv(fx.filings_wide(spark, sf), path)
    return src.read_csv(spark, path)


@query
def table_round_trip(spark, sf):
    path = staging.new_folder(spark, "filings")
    src.write_table(wide(spark, sf), path, partition_by="year")
    return src.read_wide(spark, path, years=[2019, 2020]).select(
        "filename", "cik", "year", "section_1", "section_1A", "section_7", "section_15"
    )


@query
def scan_raw(spark, sf):
    """Filings written by year and split, read with both."""
    path = staging.new_folder(spark, "raw")
    part = F.when(F.col("doc_id") % 3 == 0, "test").otherwise("train")
    rows = fx.filings_raw(spark, sf).withColumn("split", part)
    rows.drop("doc_id").write.partitionBy("year", "split").parquet(path)
    return src.read_raw(spark, path, year=2020, split="train")


@query
def scan_wide_extra_sections(spark, sf):
    """Sections that are not declared are kept, numbers become text."""
    path = staging.new_folder(spark, "wide")
    rows = fx.filings_wide(spark, sf).withColumn("section_9C", F.upper("section_2"))
    rows = rows.withColumn("section_16", F.length("section_1")).withColumn("year", F.col("year").cast("long"))
    src.write_table(rows, path)
    found = src.read_wide(spark, path, cik="src3", years=[2018, 2020])
    return found.select("filename", "cik", "year", "section_2", "section_9C", "section_16", "section_15")


@query
def csv_many_files(spark, sf):
    """Two files whose columns differ in order and number."""
    path = staging.new_folder(spark, "files")
    rows = fx.filings_wide(spark, sf).select("filename", "cik", "year", "section_2", "section_8")
    src.write_csv(rows.where("year = 2020"), f"{path}/a")
    src.write_csv(rows.where("year <> 2020").select("section_8", "year", "cik", "filename"), f"{path}/b")
    return src.read_csv(spark, path)


@query
def years_sorted(spark, sf):
    return profile.years_sorted(wide(spark, sf))


@query
def stage_counts(spark, sf):
    filings, n_filings = staging.observed(fx.filings_raw(spark, sf), "filings")
    sections, n_sections = staging.observed(extract_sections(filings), "sections")
    chunks, n_chunks = staging.observed(chunk.chunk_words(sections, "section_text"), "chunks")
    chunks.write.format("noop").mode("overwrite").save()
    counts = [
        ("filings", n_filings.get["rows"]),
        ("sections", n_sections.get["rows"]),
        ("chunks", n_chunks.get["rows"]),
    ]
    return spark.createDataFrame(counts, "stage STRING, n_rows LONG")


# Text


@query
def sections(spark, sf):
    filings = fx.filings_raw(spark, sf).select("doc_id", "text")
    return extract_sections(filings).select("doc_id", "section_title", "section_text")


@query
def sections_keep_last(spark, sf):
    filings = fx.filings_raw(spark, sf).select("doc_id", "text")
    return extract_sections(filings, keep_last=True).select(
        "doc_id", "section_title", "section_text"
    )


@query
def chunk_words(spark, sf):
    documents = fx.documents(spark, sf).select("doc_id", "text")
    return chunk.chunk_words(documents, size=50)


@query
def chunk_overlap(spark, sf):
    documents = fx.documents(spark, sf).select("doc_id", "text")
    return chunk.chunk_words(documents, size=50, overlap=10)


@query
def chunk_sentences(spark, sf):
    documents = fx.documents(spark, sf).select("doc_id", "text")
    return split.chunk_sentences(documents, size=60)


@query
def chunk_recursive(spark, sf):
    """Lines are paragraphs here."""
    documents = fx.documents(spark, sf).select("doc_id", "text")
    return split.chunk_recursive(documents, size=60, overlap=10, paragraph=r"\n")


@query
def chunk_semantic(spark, sf):
    documents = fx.documents(spark, sf).select("doc_id", "text")
    return split.chunk_semantic(documents, hash_bow(), percentile=0.9, size=60)


@query
def chunk_raw(spark, sf):
    return chunk.chunk_raw(fx.filings_raw(spark, sf))


@query
def chunk_wide(spark, sf):
    return chunk.chunk_wide(wide(spark, sf))


@query
def chunk_metadata(spark, sf):
    return chunk.chunk_metadata(chunk.chunk_wide(wide(spark, sf), size=200))


# Embedding


@query
def embed_chunks(spark, sf):
    embedded = index_chunks(wide(spark, sf), hash_bow())
    cells = embedded.select("chunk_id", F.posexplode("embedding").alias("bucket", "weight"))
    return cells.where(F.col("weight") > 0).select("chunk_id", "bucket", rounded("weight", 6))


@query
def embed_shape(spark, sf):
    return profile.embedding_shape(index_chunks(wide(spark, sf), hash_bow()))


def letter_counts() -> Encoder:
    """A model of one's own: the characters, the blanks and a constant."""

    def load():
        return lambda texts: np.array([[len(t), t.count(" "), 1] for t in texts], np.float32)

    return Encoder(load, batch_size=32)


@query
def embed_pandas(spark, sf):
    """The user's model in batches of 32; some texts are null."""
    text = F.when(F.col("doc_id") % 7 != 0, F.col("text"))
    rows = fx.documents(spark, sf).select("doc_id", text.alias("text"))
    vector = F.col("embedding")
    return embed(rows, letter_counts(), "text").select(
        "doc_id", *[vector[i].cast("double").alias(c) for i, c in enumerate(("n", "blanks", "one"))]
    )


@query
def embed_questions(spark, sf):
    items = fx.items(spark, sf).select(F.col("item_id").alias("query_id"), "query", "year")
    cells = search.embed_queries(items, hash_bow()).select(
        "query_id", F.posexplode("embedding").alias("bucket", "weight")
    )
    return cells.where(F.col("weight") > 0).select("query_id", "bucket", rounded("weight", 6))


# Clusters and outliers


@query
def scale(spark, sf):
    vectors = with_vector(embeddings(spark, sf))
    scaled = cluster.fit_scaler(vectors).transform(vectors)
    return scaled.select(
        "vec_id", F.posexplode(vector_to_array("scaled_embedding")).alias("dim", "value")
    ).select("vec_id", "dim", rounded("value", 6))


@query
def pca2(spark, sf):
    vectors = with_vector(embeddings(spark, sf))
    scaled = cluster.fit_scaler(vectors).transform(vectors)
    reduced = cluster.first_two(cluster.fit_pca(scaled).transform(scaled))
    point = vector_to_array("pca_features_2d")
    return reduced.select("vec_id", point[0].alias("x"), point[1].alias("y"))


@query
def pca_lengths(spark, sf):
    """With all components kept the reduction is a rotation: it keeps every length."""
    vectors = with_vector(embeddings(spark, sf))
    scaled = cluster.fit_scaler(vectors).transform(vectors)
    rotated = cluster.fit_pca(scaled, 64).transform(scaled)
    length = v.norm(vector_to_array("pca_features_50"))
    return rotated.select("vec_id", F.round(length, 6).alias("length"))


@query
def pca_correlation(spark, sf):
    """Components don't correlate, and the first ones vary most."""
    vectors = with_vector(embeddings(spark, sf))
    scaled = cluster.fit_scaler(vectors).transform(vectors)
    reduced = cluster.fit_pca(scaled, 8).transform(scaled)
    matrix = Correlation.corr(reduced, "pca_features_50").first()[0].toArray()
    values = vector_to_array("pca_features_50")
    spread = reduced.select(*[F.var_samp(values[i]) for i in range(8)]).first()
    falls = [i == 0 or spread[i] <= spread[i - 1] for i in range(8)]
    rows = [(i, j, round(float(matrix[i, j]), 6) + 0.0, falls[i]) for i in range(8) for j in range(8)]
    return spark.createDataFrame(rows, "i INT, j INT, correlation DOUBLE, falls BOOLEAN")


@query
def kmeans_nearest(spark, sf):
    """Every row is in the cluster of its nearest center; all rows are in one."""
    rows = embeddings(spark, sf)
    model = cluster.fit_clusters(rows)
    centers = cluster.center_table(model.kmeans, rows).select(F.collect_list("center").alias("centers"))
    placed = model.apply(rows).crossJoin(F.broadcast(centers))
    point = vector_to_array("pca_features_2d")
    nearest = F.array_min(F.transform("centers", lambda c: v.euclidean(point, c)))
    return placed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("distance_to_center") > nearest + 1e-5).alias("n_not_nearest"),
        F.countDistinct("vec_id").alias("n_members"),
    )


@query
def kmeans7(spark, sf):
    clustered = cluster.process_and_cluster(embeddings(spark, sf))
    return clustered.select(
        "vec_id", "prediction", "distance_to_center", "mean_dist", "std_dist", "is_outlier"
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The label as cluster, its mean vector as center: no fit is involved."""
    rows = embeddings(spark, sf).withColumnRenamed("label", "prediction")
    return cluster.center_distance(rows, cluster.mean_centers(rows), "embedding")


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.flag_outliers(labelled(spark, sf))


@query
def center_distance(spark, sf):
    rows = labelled(spark, sf)
    return rows.select("vec_id", "prediction", rounded("distance_to_center", 4))


@query
def cluster_stats(spark, sf):
    rows = labelled(spark, sf)
    return cluster.cluster_stats(rows).select(
        "prediction", rounded("mean_dist", 4), rounded("std_dist", 4)
    )


@query
def outliers(spark, sf):
    return flagged(spark, sf).select(
        "vec_id",
        "prediction",
        rounded("distance_to_center", 4),
        rounded("mean_dist", 4),
        rounded("std_dist", 4),
        "is_outlier",
    )


def clusterings(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[int, str]]:
    """The labels in two, three, five and ten clusters: no fit is involved."""
    assigned = {k: f"in_{k}" for k in (2, 3, 5, 10)}
    return embeddings(spark, sf).withColumns({c: F.col("label") % k for k, c in assigned.items()}), assigned


@query
def choose_k(spark, sf):
    scores = choose.silhouettes(*clusterings(spark, sf), "embedding")
    return scores.select("k", "n_clusters", rounded("silhouette", 6))


@query
def elbow(spark, sf):
    found = choose.elbow(*clusterings(spark, sf), "embedding")
    return found.select("k", rounded("cost", 4), rounded("distance", 6), "is_elbow")


@query
def choose_k_fitted(spark, sf):
    """Fits for four numbers of clusters; each has as many clusters as asked for."""
    vectors = with_vector(embeddings(spark, sf))
    scaled = cluster.fit_scaler(vectors).transform(vectors)
    reduced = cluster.first_two(cluster.fit_pca(scaled).transform(scaled))
    scores = choose.choose_k(reduced, (2, 3, 5, 7)).scores
    between = F.col("silhouette").between(-1, 1) & (F.col("cost") > 0)
    return scores.select("k", "n_clusters", between.alias("in_range"))


@query
def explore_filings(spark, sf):
    return explore(fx.filings_raw(spark, sf), hash_bow()).plots["combined"]


@query
def explore_counts(spark, sf):
    rows = explore(fx.filings_raw(spark, sf), hash_bow()).rows
    return spark.createDataFrame(list(rows.items()), "stage STRING, n_rows LONG")


# Retrieval


@query
def cosine_to_center(spark, sf):
    rows = embeddings(spark, sf)
    centers = cluster.mean_centers(rows, "label")
    score = v.cosine(v.doubles(F.col("embedding")), F.col("center"))
    return rows.join(centers, "label").select(
        "vec_id", "label", F.round(score, 6).alias("similarity")
    )


def centers_as_queries(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.mean_centers(embeddings(spark, sf), "label").select(
        F.col("label").alias("query_id"), "label", F.col("center").alias("embedding")
    )


@query
def cosine_topk(spark, sf):
    hits = search.top_k(
        embeddings(spark, sf),
        centers_as_queries(spark, sf),
        order_by=("vec_id",),
        scope=None,
    )
    return hits.select("query_id", "rank", "vec_id", "label", rounded("similarity_score", 6))


@query
def cosine_topk_scoped(spark, sf):
    hits = search.top_k(
        embeddings(spark, sf),
        centers_as_queries(spark, sf),
        order_by=("vec_id",),
        scope="label",
    )
    return hits.select("query_id", "rank", "vec_id", "label", rounded("similarity_score", 6))


@query
def cosine_topk_nonfinite(spark, sf):
    """Vectors with an infinite, missing or undefined component are left out."""
    broken = [(3, F.lit(float("inf"))), (4, F.lit(None)), (5, F.lit(float("nan")))]
    vector = F.col("embedding")
    for label, value in broken:
        spoilt = F.concat(F.array(value.cast("float")), F.slice("embedding", 2, 10_000))
        vector = F.when((F.col("label") == label) & (F.col("vec_id") % 2 == 0), spoilt).otherwise(vector)
    rows = embeddings(spark, sf).withColumn("embedding", vector)
    hits = search.top_k(rows, centers_as_queries(spark, sf), order_by=("vec_id",), scope=None)
    return hits.select("query_id", "rank", "vec_id", "label", rounded("similarity_score", 6))


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    chunks = index_chunks(wide(spark, sf), hash_bow())
    items = fx.items(spark, sf).select(F.col("item_id").alias("query_id"), "query", "year")
    return search.search(chunks, items, hash_bow(), 5)


@query
def semantic_search(spark, sf):
    return search_hits(spark, sf).withColumn("similarity_score", rounded("similarity_score", 6))


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return fx.items(spark, sf).select(F.col("item_id").alias("query_id"), "query", "year")


@query
def bm25_search(spark, sf):
    """All questions by keywords, on an index that was written and read back."""
    path = staging.new_folder(spark, "keyword_index")
    # Written first: laying chunks out in order reads them twice.
    chunks, _ = staging.stage(chunk.chunk_wide(wide(spark, sf)), "chunks")
    keyword.build(chunks, path=path)
    hits = keyword.search(keyword.load(spark, path), questions(spark, sf), 5)
    return hits.withColumn("similarity_score", rounded("similarity_score", 6))


def both_lists(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The twenty best hits of every question, by vectors and by keywords."""
    chunks, _ = staging.stage(index_chunks(wide(spark, sf), hash_bow()), "chunks")
    asked = questions(spark, sf)
    by_vector = search.search(chunks, asked, hash_bow(), 20)
    return [by_vector, keyword.search(keyword.build(chunks.drop("embedding")), asked, 20)]


@query
def hybrid_search(spark, sf):
    """Reciprocal rank fusion of both lists."""
    hits = keyword.fuse(both_lists(spark, sf), 5)
    return hits.withColumn("similarity_score", rounded("similarity_score", 6))


@query
def hybrid_search_weighted(spark, sf):
    """Scores scaled within each list, keywords at three tenths."""
    hits = keyword.fuse(both_lists(spark, sf), 5, how="minmax", weights=[0.7, 0.3])
    return hits.withColumn("similarity_score", rounded("similarity_score", 6))


@query
def search_expanded(spark, sf):
    """Words that follow each other in the benchmark stand for each other."""
    words = F.split(F.lower("text"), " ")
    pairs = fx.table(spark, sf, "benchmark").select(
        F.explode(F.array(*[F.struct(words[0].alias("word"), words[i].alias("synonym"), F.lit(w).alias("weight")) for i, w in ((1, 0.9), (2, 0.5))])).alias("pair")
    )
    pairs = pairs.select("pair.*").groupBy("word", "synonym").agg(F.max("weight").alias("weight"))
    chunks, _ = staging.stage(index_chunks(wide(spark, sf), hash_bow()), "chunks")
    hits = refine.search_expanded(chunks, questions(spark, sf), pairs, hash_bow(), 5)
    return hits.withColumn("similarity_score", rounded("similarity_score", 6))


@query
def search_reranked(spark, sf):
    """Twenty hits by cosine, five of them by the words they share with the question."""
    chunks, _ = staging.stage(index_chunks(wide(spark, sf), hash_bow()), "chunks")
    hits = refine.search_reranked(chunks, questions(spark, sf), hash_bow(), refine.word_overlap(), 5)
    return hits.withColumn("similarity_score", rounded("similarity_score", 6))


@query
def search_empty_year(spark, sf):
    chunks = index_chunks(wide(spark, sf), hash_bow())
    return search.search_one(chunks, "the and of", 1999, hash_bow())


@query
def ask_one(spark, sf):
    chunks = index_chunks(wide(spark, sf), hash_bow())
    hits = ask(chunks, "  The and\nof with ", 2020, hash_bow())
    return hits.withColumn("similarity_score", rounded("similarity_score", 6))


@query
def retrieval_job(spark, sf):
    """The written job over a year; its checked items."""
    return retrieve(wide(spark, sf), fx.items(spark, sf), hash_bow()).checked


@query
def validation_items(spark, sf):
    return evaluate.validation_items(wide(spark, sf), fx.items(spark, sf))


@query
def retrieval_eval(spark, sf):
    filings = wide(spark, sf)
    kept, _ = staging.stage(evaluate.validation_items(filings, fx.items(spark, sf)), "items")
    return evaluate.evaluate_retrieval(index_chunks(filings, hash_bow()), kept, hash_bow())


@query
def retrieval_summary(spark, sf):
    checked = evaluate.summarise(retrieval_eval(spark, sf))
    return checked.select(
        "n_items",
        "n_hit_at_1",
        "n_hit_in_k",
        "n_without_hits",
        rounded("hit_rate_at_1", 6),
        rounded("hit_rate_in_k", 6),
    )


# Plot tables


def points(spark: SparkSession, sf: str) -> DataFrame:
    """The first two components as the plane, document columns as section and company."""
    rows = flagged(spark, sf)
    documents = fx.table(spark, sf, "documents").select(
        F.col("doc_id").alias("vec_id"),
        F.col("lang").alias("section_title"),
        F.col("source").alias("company_name"),
    )
    plane = array_to_vector(F.slice(v.doubles(F.col("embedding")), 1, 2))
    rows = rows.withColumn("pca_features_2d", plane).join(documents, "vec_id", "left")
    return plots.plot_points(rows)


def binned(table: DataFrame) -> DataFrame:
    return table.withColumns({"x": rounded("x", 6), "y": rounded("y", 6)})


@query
def plot_points(spark, sf):
    return binned(points(spark, sf))


@query
def plot_clusters(spark, sf):
    return binned(plots.by_cluster(points(spark, sf), 0.05))


@query
def plot_outliers(spark, sf):
    return binned(plots.by_outlier(points(spark, sf), 0.05))


@query
def plot_sections(spark, sf):
    return binned(plots.by_section(points(spark, sf), 0.05))


@query
def plot_combined(spark, sf):
    return binned(plots.by_company(points(spark, sf), 0.05))


@query
def plot_sample(spark, sf):
    """All of one cluster, a third of another, half of the rest but one."""
    fractions = {0: 1.0, 1: 1 / 3, **{c: 0.5 for c in range(2, 9)}}
    sample = plots.sample_by_hash(labelled(spark, sf), fractions, "vec_id", seed=7)
    return sample.select("vec_id", "prediction")


@query
def plots_written(spark, sf):
    """The result tables as they are written and read back."""
    path = staging.new_folder(spark, "plots")
    rows = points(spark, sf)
    tables = {"combined": plots.by_company(rows, 0.05), "points": rows}
    write_plots(Exploration(rows, tables, {}), path)
    return binned(spark.read.parquet(f"{path}/combined"))
