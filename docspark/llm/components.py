"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docspark.sources import staging


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each node of ``links`` (u, v) reaches, as (node, label).

    Alternates the large-star and the small-star step until every link leads straight to the
    smallest node of its component.  Each step groups links by one end with partial
    aggregation, and its result is a written table, so lineage stays short and lost
    executors cost one step.  Null ends, loops and repeated links are ignored; an empty
    table of links gives an empty table.
    """
    now = links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, n = staging.stage(now, "links")
    while n:
        step, _ = staging.stage(_small_star(_large_star(now)), "links")
        # Done when no link is new: then no step changes anything any more.
        moved = step.join(now, ["u", "v"], "left_anti").limit(1).count()
        now = step
        if not moved:
            break
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(tops)


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node with the smallest node around it."""
    both = links.union(links.select("v", "u"))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, with the smallest of them."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    to_all = links.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_all.union(smallest.select("u", F.col("m").alias("v"))).distinct()
