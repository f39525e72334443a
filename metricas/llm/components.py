"""Connected components of a graph too large for one machine (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a larger-to-smaller link.

    A component's smallest node itself has no row. Large-star links each node's
    larger neighbours to its smallest one, small-star its smaller neighbours;
    the two alternate until nothing changes. Only two numbers per round reach
    the driver; each round's edges are a table in the shared folder.
    """
    edges = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u <> v").distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .distinct())
        edges = staged(small, "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
