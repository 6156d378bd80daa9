"""Connected components of a graph of links, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of u links to u's smallest neighbour (or u). Small star: every smaller
    neighbour, and u itself, does. Partial minima are taken before the shuffle; a hub's row joins its links under AQE,
    which splits a hot hub."""
    both = edges if not large else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for every node with a link, the smallest node that it is connected with. Self links count
    for nothing. Each round is written to the shared folder; rounds end when nothing changes."""
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    links = written(links, "links")
    state = None
    while True:
        links = written(_star(_star(links, True), False), "links")
        new = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            break
        state = new
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
