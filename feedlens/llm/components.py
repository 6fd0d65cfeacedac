"""Connected components by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with the smallest of u and its partners as m.

    The minima are written first: both join sides then come from an exchange
    and adaptive execution can split a hub's rows."""
    mins = materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
    return pairs.join(mins, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    got = _smallest(edges)
    return (got.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(got.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Edges with a null end are ignored and a self edge adds its node. Each
    round shuffles the edge table a constant number of times and the number
    of rounds grows with the square of the logarithm of the graph's size.
    Only a row count and a checksum reach the driver."""
    ends = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    ends = materialize(ends, "cc-edges")
    nodes = ends.select(F.col("u").alias("node")).union(ends.select("v")).distinct()
    now = materialize(ends.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "cc-0")
    mark = _mark(now)
    while mark[0]:
        large = materialize(_large_star(now), "cc-large")
        now = materialize(_small_star(large), "cc-small")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return (nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left")
            .withColumn("component", F.coalesce("component", "node")))
