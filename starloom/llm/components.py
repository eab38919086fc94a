"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.durable import durable


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v): component is the smallest node reachable.

    Each round points a node's larger neighbours, then its smaller ones, to the smallest in sight; both are
    grouped minima, combined map-side, and joins whose hot nodes AQE can split. Rounds grow with the logarithm
    of the longest path. Each round is stored in the shared folder; the driver sees a row count and a checksum.
    Rows with equal or null ends are ignored.
    """
    edges = durable(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = durable(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        met = edges.join(least, "u")
        edges = durable(met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
                        "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
