"""Connected components by alternating large and small stars.

Every round replaces edges by edges to the smallest neighbour, with one grouped minimum and one
join per star; the number of rounds grows with the logarithm of the longest chain. Minima are
combined before the shuffle, so a node that holds a third of all edges costs one row per map
task, and the joins meet one row per node, which AQE splits on the edge side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateloom.runtime import materialize_observed, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v, distinct."""
    if large:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(least, "u")
        out = near.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; root is the smallest node of its component.

    Nodes may be of any ordered type. Loops and repeated edges do no harm; null ends are left out.
    """
    clean = edges.where("u is not null and v is not null")
    nodes = clean.select("u").union(clean.select("v")).toDF("node").distinct()
    current, mark = _written(clean.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        nxt, seen = _written(_star(_star(current, True), False))
        release(current)
        current = nxt
        if seen == mark:
            break
        mark = seen
    return nodes.join(current.toDF("node", "low"), "node", "left").select(
        "node", F.coalesce("low", "node").alias("root")
    )


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, with an order-free fingerprint taken while they are written."""
    out, seen = materialize_observed(
        edges, n=F.count("*"), total=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), mix=F.bit_xor(F.xxhash64("v", "u"))
    )
    return out, (seen["n"], seen["total"], seen["mix"])
