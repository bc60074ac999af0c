"""Connected components by alternating large-star and small-star rounds (published algorithm), as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _digest(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root: the smallest node of its component.

    Each round is written to the shared folder. A hub's neighbours are grouped by a partial
    minimum and joined back, so no list of neighbours is ever built.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _digest(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("x"), F.col("m").alias("y"))
        small = small.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        e = saved(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _digest(e)
        if now == seen:
            break
        seen = now
    star = e.groupBy("a").agg(F.min("b").alias("root"))
    return star.select(F.col("a").alias("node"), "root").unionByName(
        star.select(F.col("root").alias("node"), "root").distinct())
