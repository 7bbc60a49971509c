"""Connected components of links between ids, by large and small stars.

Each round links the larger neighbours of a node to its smallest one, then the smaller ones. Smallest neighbours are
found by partial aggregation and joined back, so a node with very many links is never collected; Spark may
split such a node in the join. A round's edges are written, so no lineage grows. Rounds end when all edges make stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v, of the next step."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select("v", "m").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def linked(links: DataFrame) -> DataFrame:
    """Distinct edges (u, v), u > v, of ``links`` (a, b), written."""
    return written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")


def contracted(edges: DataFrame) -> DataFrame:
    """Edges after one round: they join the same ids, nearer to stars around the smallest ones."""
    return written(_star(_star(edges, True), False), "stars")


def nearest(edges: DataFrame) -> DataFrame:
    """(id, component): for each larger end the smallest id it has an edge to, which is in its component but may not be the
    smallest there."""
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))


def _settled(edges: DataFrame) -> bool:
    """Whether all edges make stars: no id is the larger end of two, or of one and the smaller end of another."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up")))
    ends = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
    return ends.agg(F.count_if(F.expr("ups > 0 and n > 1"))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(id, component): for each id of ``links`` (a, b) the smallest id that can be reached from it."""
    edges = contracted(linked(links))
    while not _settled(edges):
        edges = contracted(edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
