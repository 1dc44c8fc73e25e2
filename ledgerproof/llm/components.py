"""Connected components of a link table, by alternating large-star and small-star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select(
        F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
    return both.where("v > u").join(least, F.col("u") == F.col("_u")).select(
        F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("_m"))
    moved = edges.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).where("v <> _m").select(
        F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.union(least.select("u", F.col("_m").alias("v"))).where("u <> v").distinct()


def stars(links: DataFrame) -> DataFrame:
    """``links`` (u, v) of comparable keys -> (u, v) with v the smallest key that u reaches, u <> v.

    Every round is one written table, so lineage stays short; rounds grow with the logarithm of the longest
    chain. Self links are ignored; keys without a link do not appear."""
    edges = written(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        if now == mark or not now[0]:
            return edges
        mark = now
