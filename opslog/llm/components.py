"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on a node, so no component is ever
collected anywhere; a node with very many edges only makes a skewed join key,
which adaptive execution splits.  Each round's edges are written to the shared
checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.session import materialize

MAX_ROUNDS = 60  # rounds grow with the logarithm of the longest path; this bound is an error, not a cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (u, v) rows: ``large`` links every larger neighbour, otherwise every smaller one, to the least."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large \
        else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another; the component is its smallest node.

    ``edges`` has columns u and v (long); direction, repeats and loops do not matter; nulls are left out.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_star(_star(now, large=True), large=False), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
    raise RuntimeError("connected components did not settle")
