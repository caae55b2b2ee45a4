"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.sources.tables import few, materialise

_JUMPS = 2


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    ``known``, an earlier answer, is grown by the edges: all that is followed then is what the new
    edges join, its components counting as one node each.

    Every node hooks to its smallest neighbour, the hooks are followed a few times, and the
    graph is contracted to the nodes reached, until no edge is left. Each round is written
    to the shared work folder, so a lost executor costs one round at most, by as many tasks
    as the edges then left need. Hubs are no burden: all a hub's task keeps is a minimum,
    taken partly before the shuffle.
    """
    spark = edges.sparkSession
    rows = 2 * edges.count()
    found = edges.select("a", "b")
    if known is not None:
        for end in ("a", "b"):
            step = known.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
            found = found.join(step, end, "left").withColumn(end, F.coalesce(f"{end}_root", end)).drop(f"{end}_root")
        found = materialise(few(found.select("a", "b").distinct(), rows), "found")
    found = found.filter("a <> b")
    left = materialise(few(found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), rows), "edges")
    roots: DataFrame | None = None
    nodes = 0
    while rows := left.count():
        nodes = nodes or rows  # at most, each being the start of an edge
        up = left.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hooks = up = materialise(few(up, rows), "hooks")
        for _ in range(_JUMPS):
            up = _followed(up, hooks)
        up = materialise(few(up, rows), "jumped")
        roots = up if roots is None else materialise(few(_followed(roots, up), nodes), "roots")
        moved = left
        for end in ("a", "b"):
            step = up.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
            moved = moved.join(step, end)
        left = materialise(
            few(moved.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).filter("a <> b").distinct(), rows), "edges"
        )
    if known is not None:
        if roots is None:
            return known
        added = roots.join(known.select("node"), "node", "left_anti")
        return materialise(few(_followed(known, roots).unionByName(added), known.count() + nodes), "roots")
    if roots is None:
        return spark.createDataFrame([], left.select(F.col("a").alias("node"), F.col("b").alias("root")).schema)
    return roots


def _followed(at: DataFrame, up: DataFrame) -> DataFrame:
    """Every (node, root) moved on to the root's root, where ``up`` knows it."""
    further = up.select(F.col("node").alias("root"), F.col("root").alias("higher"))
    return at.join(further, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
