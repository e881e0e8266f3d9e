"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of a link; the root is the smallest node it can reach.

    Every round hangs the neighbours of a node on the smallest of them, by a grouped minimum and a
    join, so no neighbourhood is gathered; the number of rounds grows with the logarithm of the
    longest path. Edges are staged after each round, and only their count and a checksum reach the
    driver. Links of a node to itself and null ends are left out.
    """
    edges = stage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter(f"{a} <> {b}").distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        # large star: larger neighbours of u go to the smallest around u
        large = both.join(lowest, both["u"] == lowest["k"]).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u, go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (large.join(least, large["u"] == least["k"]).filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        edges = stage(small, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()
