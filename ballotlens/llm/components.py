"""Connected components of a link table, by alternating large and small stars.

Every step is a join and an aggregation over the links; nothing but two
numbers (link count and checksum) reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotlens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (edges.join(least, "a").filter(F.col("b") > F.col("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): each id that occurs in a link, with the smallest id
    reachable from it. Self links and null ends are ignored; an empty link
    table gives an empty result."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    links = (edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
             .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") > F.col("b"))).distinct())
    mark = None
    while True:
        links = stored(links, "components")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(now) or not now[0]:
            break
        mark = tuple(now)
        links = _small_star(_large_star(links))
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
