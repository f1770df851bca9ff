"""Connected components of an edge table by alternating large-star and small-star steps; nothing is sent to the driver
but one checksum per step. Every step is written to the shared folder, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foresight.session import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    return (e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .union(low.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (a, b): component is the smallest node reachable.

    Loops and repeated edges are allowed; no edges give no rows."""
    e = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    e = materialize(e, "edges")
    total = _sum(e)
    while total[0]:
        e = materialize(_small_star(_large_star(e)), "edges")
        new = _sum(e)
        if new == total:
            break
        total = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())


def _sum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
