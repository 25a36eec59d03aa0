"""Connected components by alternating stars, cut by reliable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weirgate.operators.keys import one_per_key
from weirgate.session import cut_lineage


def _hand_down(edges: DataFrame, whole: bool) -> DataFrame:
    """Every node hands its smallest neighbour on: with ``whole`` to its larger neighbours, else to its smaller ones (edges
    run from the larger node ``a`` to the smaller ``b``) and to itself."""
    if whole:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = one_per_key(both, ["a"], F.min("b").alias("m"))
        made = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        least = one_per_key(edges, ["a"], F.min("b").alias("m"))
        made = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return made.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it is connected with) for every node of ``edges`` (``a, b``, any sortable type)."""
    held = cut_lineage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        held = cut_lineage(_hand_down(_hand_down(held, True), False))
    roots = held.select(F.col("b").alias("node")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))


def extended(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (``node, component``) after more ``edges`` (``a, b``): only the components that these connect are looked at
    again, as nodes of a smaller graph. Ends that are not among ``nodes`` are components of their own until then."""
    labels = [nodes.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")) for end in "ab"]
    bridges = cut_lineage(
        edges.join(labels[0], "a", "left").join(labels[1], "b", "left")
        .select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a != b").distinct())
    if bridges.isEmpty():
        return nodes
    roots = cut_lineage(components(bridges))
    above = roots.select(F.col("node").alias("component"), F.col("component").alias("_root"))
    moved = nodes.join(above, "component", "left").select("node", F.coalesce("_root", "component").alias("component"))
    return moved.unionByName(roots.join(nodes, "node", "left_anti"))
