"""Connected components as DataFrame joins.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014).  Every step keeps at most one
row per edge, a node with a third of all edges is reduced by a partial minimum
before the shuffle, and the join that hands the minimum back is an ordinary
equi-join that skew handling can split.  Each round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import staged


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge list."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["x"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``.

    ``component`` is the smallest node that links reach.  Loops and repeated
    edges are allowed; rows with a null end are ignored; without edges the
    result is empty.
    """
    e = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .distinct(), "links")
    before = _fingerprint(e)
    while before[0]:
        both = e.union(e.select("v", "u")).toDF("node", "nbr")
        low = both.groupBy("node").agg(F.min("nbr").alias("low"))
        large = (both.where("nbr > node").join(low, "node")
                 .select(F.col("nbr").alias("u"), F.least("low", "node").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .union(low.select("u", F.col("low").alias("v"))).distinct())
        e = staged(small, "links")
        now = _fingerprint(e)
        if now == before:
            break
        before = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select("v", "v").distinct()))
