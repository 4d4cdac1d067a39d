"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.tables import written


def _roots(parents: DataFrame) -> DataFrame:
    """Follow ``parent`` (always smaller than ``node``) to the end; the number of rounds is the
    logarithm of the longest chain."""
    while True:
        up = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_up"))
        jumped = parents.join(up, parents.parent == up._node, "left").select(
            "node", F.coalesce("_up", "parent").alias("parent"), (F.col("_up") != F.col("parent")).alias("_moved")
        )
        jumped = written(jumped, "jumped")
        moved = not jumped.filter("_moved").isEmpty()
        parents = jumped.drop("_moved")
        if not moved:
            return parents


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b; longs): the smallest node it reaches.

    Every node takes its smallest neighbour as parent where that is smaller than
    itself, the resulting trees are collapsed to their roots, and edges between
    roots remain. A root has a smaller-or-equal id than its neighbours, so each
    round at least halves the nodes that still have edges. All steps are joins
    and minima that combine map-side; a node with very many edges meets no task
    of its own. Self-edges and repeated edges are fine; without edges the result is empty.
    """
    edges = written(edges.select("a", "b").distinct(), "edges")
    result = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parents = both.groupBy("node").agg(F.min(F.least("node", "other")).alias("parent"))
        roots = _roots(written(parents, "parents"))
        if result is None:
            result = roots.select("node", F.col("parent").alias("label"))
        else:
            step = roots.select(F.col("node").alias("_from"), F.col("parent").alias("_to"))
            result = result.join(step, result.label == step._from, "left").select("node", F.coalesce("_to", "label").alias("label"))
        left, right = (roots.select(F.col("node").alias(c), F.col("parent").alias(f"root_{c}")) for c in "ab")
        edges = written(
            edges.join(left, "a").join(right, "b").filter("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(),
            "edges",
        )
        if edges.isEmpty():
            return written(result, "components")
