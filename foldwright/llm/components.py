"""Connected components of a graph given as edges, by alternating stars.

The large star hangs the larger neighbours of a node on its smallest one, the
small star the smaller ones; in the end each node hangs on the smallest of its
component. Every round is written to the shared folder, which ends the lineage.
A node with many edges is aggregated before the shuffle, and the join with the
minima has one row per node on its right side, so Spark can split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.workspace import materialise


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that is not the smallest of its component.

    Null ends and loops are no edges; repeated edges count once.
    """
    rows = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull() & F.col(b).isNotNull())
    rows = rows.toDF("u", "v", "whole").filter("whole and u != v").select("u", "v").distinct()
    stars = materialise(rows, "edges")
    before = _signature(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "stars")
        now = _signature(stars)
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
