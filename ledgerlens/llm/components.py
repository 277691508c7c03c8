"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.stability import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links → (node, root): every linked node with the least node it can reach.

    Each step sends a node's neighbours to its least neighbour: minima come from a map-side
    aggregation, and a hub's rows meet its one minimum in a join that adaptive execution can split.
    Edges never outnumber the input, so those counted before a step say how many files its tables
    need.  Nothing is gathered per component, and a component of any diameter takes about log² steps.
    """
    edges = materialise(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = materialise(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), before[0],
        )
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(moved.union(lower.select("a", F.col("m").alias("b"))).distinct(), before[0])
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
