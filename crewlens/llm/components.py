"""Connected components of a graph given as a table of edges, by alternating star steps.

A large-star step links every larger neighbour of a node to its smallest neighbour, a small-star
step does the same with the smaller ones. Each step is a minimum per node, folded before the
shuffle, and a join back; a node with very many neighbours is one key of a plain join, which
adaptive execution can split. Edges are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.session import passing, stored


def own_exchange(folded: DataFrame, key: str) -> DataFrame:
    """A folded table that joins by an exchange of its own instead of its fold's: only then can
    adaptive execution split the other side where a key is frequent."""
    return folded.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("bigint")))


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _nearest(both).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(own_exchange(least, "u"), "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: u > v."""
    least = _nearest(edges)
    moved = edges.join(own_exchange(least, "u"), "u").filter("v > m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
        least.select("u", F.col("m").alias("v"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Every node links once, to a node that links to none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("links"), F.lit(0).alias("roots")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("links"), F.lit(1).alias("roots")))
    seen = ends.groupBy("x").agg(F.sum("links").alias("links"), F.max("roots").alias("roots"))
    return seen.filter((F.col("links") > 1) | ((F.col("links") > 0) & (F.col("roots") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v, any order, without nulls. Returns u, component: the smallest node each node
    reaches, for every node but those smallest ones themselves."""
    with passing(edges.sparkSession) as keep:
        now = stored(
            edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "edges")
        while not _is_done(now):
            now = stored(_small_star(_large_star(now)), "edges")
        keep(now)
    return now.select("u", F.col("v").alias("component"))
