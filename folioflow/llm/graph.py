"""Connected components over an edge table, as repeated equi-joins in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(node, comp) for every node of edges(a, b); comp is the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label's own label (pointer jumping), so the
    rounds grow with the logarithm of the longest path. Labels are written each round; a hub's rows are split by the
    adaptive skew join and its minimum is combined map-side.
    """
    both = ws.table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    lab = ws.table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), f"{name}-0")
    k = 0
    while True:
        near = both.join(lab, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("m"))
        low = lab.join(near, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        # A label is itself a node; its own label of the round before is a node of the same component.
        jump = low.join(lab.select(F.col("node").alias("at"), F.col("comp").alias("further")), F.col("comp") == F.col("at"), "left")
        nxt = ws.table(jump.select("node", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")), f"{name}-{k + 1}")
        changed = not nxt.where("old <> comp").isEmpty()
        ws.drop(f"{name}-{k}")
        lab, k = nxt.select("node", "comp"), k + 1
        if not changed:
            ws.drop(f"{name}-edges")
            return lab
