"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationloom.storage import materialize


def _neighbours(edges: DataFrame) -> DataFrame:
    """Links in both directions."""
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked with the smallest vertex around it."""
    both = _neighbours(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("m"))
    found = both.join(least, F.col("a") == F.col("v")).where("b > a")
    return found.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, is linked with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "v")
    found = down.join(least, F.col("a") == F.col("v"))
    near = found.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex that has a link: the smallest id it can reach.

    Rounds are stored tables; how many are needed grows with the logarithm of the largest component's diameter.
    """
    now = materialize(edges.select("a", "b").where("a <> b"), "links")
    before = None
    while True:
        now = materialize(_small_star(_large_star(now)), "links")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max(F.xxhash64("b", "a"))
        ).first()
        if state == before:
            break
        before = state
    # now every link leads from a vertex to the smallest of its component
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
