"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, root): for every node that is not the
    smallest of its component, that smallest node. Loops and repeated edges do
    no harm; null ends are ignored; no edges give no rows.

    Rounds of contraction: every node with smaller neighbours takes the
    smallest as its parent (a hash aggregate, so a hub's edges are reduced in
    the tasks that hold them); chains of parents are halved until all point at
    local minima; then the edges between those minima form the next, smaller
    graph. Every table is checkpointed into the shared folder, so no lineage
    grows with the rounds and nothing but emptiness tests reaches the driver.
    """
    graph = materialize(_ordered(edges.select("a", "b")))
    rounds: list[DataFrame] = []
    while not graph.isEmpty():
        parents = _flattened(materialize(graph.groupBy("hi").agg(F.min("lo").alias("root")).withColumnRenamed("hi", "node")))
        rounds.append(parents)
        up, down = parents.toDF("hi", "hi_root"), parents.toDF("lo", "lo_root")
        moved = graph.join(up, "hi").filter("hi_root <> lo").select("hi_root", "lo").distinct().join(down, "lo", "left")
        graph = materialize(_ordered(moved.select(F.col("hi_root").alias("a"), F.coalesce("lo_root", "lo").alias("b"))))
    if not rounds:
        return graph.select(F.col("hi").alias("node"), F.col("lo").alias("root"))

    def resolve(later: DataFrame, earlier: DataFrame) -> DataFrame:
        moved = earlier.join(later.toDF("root", "end"), "root", "left").select("node", F.coalesce("end", "root").alias("root"))
        return materialize(moved.unionByName(later))

    return reduce(resolve, reversed(rounds))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def _flattened(parents: DataFrame) -> DataFrame:
    """Follow parents to the end: (node, root) with no root among the nodes."""
    while True:
        above = parents.toDF("root", "next")
        jumped = materialize(parents.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        parents = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return parents
