"""Connected components of a link table by alternating large and small stars.

Labels never leave Spark: each step is one aggregate (smallest neighbour) and
one join, written to the shared folder; the driver sees a count and a checksum.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every linked node; component = smallest node."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = materialize(edges, "links")
    state = _state(edges)
    while True:
        last, edges = edges, materialize(_small(_large(edges)), "star")
        discard(last)
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to u's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.filter("v > u").join(least, "u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()
