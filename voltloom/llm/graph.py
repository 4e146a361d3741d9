"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltloom.core.scratch import materialise


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Hang neighbours of each ``u`` under the smallest of its neighbourhood.

    A join and not a grouped list: the many neighbours of a hub stay spread, only the
    minimum per node is aggregated.
    """
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = pairs.join(low, "u").where(F.col("v") > F.col("u") if larger_only else F.lit(True)).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung if larger_only else hung.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); ``root`` is the smallest node reachable.

    Large-star and small-star steps alternate until no edge changes, which takes
    logarithmically many rounds; each round is written to the shared folder.
    """
    e = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        large = _stars(_both_ways(e), True)
        small = _stars(large.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), False)
        e = materialise(small.where("a <> b").distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == mark:
            break
        mark = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
