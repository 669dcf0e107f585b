"""Connected components by repeated contraction, without gathering edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``node, component`` (the least node of each component) for ``edges`` of ``u, v`` of one orderable type.

    Loops, repeated edges and edges with a null end name nobody; no edges give
    an empty table.

    Each round every node points to its least neighbour (or itself), edges are
    rewritten to the nodes pointed at, and loops and repeats go; at least half
    of the nodes that still have edges vanish a round.  A node of any degree is
    one pre-aggregated minimum; the rewriting joins can be split by key.
    """
    both = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    both = materialize(both, f"{name}-edges")
    labels = None
    turn = 0
    while not both.isEmpty():
        turn += 1
        pairs = both.select("u", "v").unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = materialize(pairs.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("to")), f"{name}-to{turn}")
        left, right = to.select(F.col("node").alias("u"), F.col("to").alias("a")), to.select(F.col("node").alias("v"), F.col("to").alias("b"))
        moved = both.join(left, "u").join(right, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        both = materialize(moved, f"{name}-edges{turn}")
        if labels is None:
            labels = to.select("node", F.col("to").alias("component"))
        else:
            step = to.select(F.col("node").alias("component"), F.col("to").alias("next"))
            labels = labels.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        labels = materialize(labels, f"{name}-labels{turn}")
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    return labels.select("node", "component")
