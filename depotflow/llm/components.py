"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from depotflow.session import frozen


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every end of ``edges(a, b)``.

    Every round lowers each node's root to the smallest among its neighbours' and then to that root's own root, so paths
    shorten by half and more. Rounds are written tables; nothing is collected but whether a root still moved. Loops and
    repeated edges do no harm; edges with a null end are left out.
    """
    ends = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = frozen(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = frozen(both.groupBy("a").agg(F.min("b").alias("near")).select(
        F.col("a").alias("node"), F.least("a", "near").alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").groupBy("a").agg(
            F.min("near").alias("near"))
        lower = roots.join(near, roots["node"] == near["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        lower = frozen(lower)
        above = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        moved = frozen(lower.join(above, "root").select("node", F.least("root", "top").alias("root"), "old"))
        roots = moved.select("node", "root")
        if not moved.where("root <> old").limit(1).count():
            return roots
