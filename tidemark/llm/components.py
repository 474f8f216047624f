"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keep_told


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, made: list | None = None) -> DataFrame:
    """(u, v) links between longs -> (node, component) with component the smallest node reachable.

    Only nodes with a link appear. Links may repeat, point either way or join a node to itself. Every round is a
    written table, so lineage stays short; rounds grow with the logarithm of a component's diameter. The tables of
    earlier rounds are deleted; the last one, which the result reads, is appended to `made`.
    """
    facts = F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    now, mark = keep_told(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links", *facts)
    while mark[0]:
        before, last = now, mark
        now, mark = keep_told(_small_star(_large_star(now)), "links", *facts)
        discard(before)
        if last == mark:
            break
    if made is not None:
        made.append(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
