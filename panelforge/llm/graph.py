"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges (u long, v long)``; the root is the smallest node of its component.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends by pointer jumping and
    contracts the edges to the ends, until no edge is left.  Minima are combined on the map side and every join
    has single rows on one side, so a component that holds a third of all nodes is no hot group.  Each step is
    written to the shared folder, so lineage does not grow.
    """
    edges = cut_lineage(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
                        .filter("u < v"), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = cut_lineage(both.groupBy("u").agg(F.min("v").alias("v"))
                           .select(F.col("u").alias("node"), F.least("u", "v").alias("root")), "hooks")
        while True:
            far = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hook = cut_lineage(hook.join(far, "root").select("node", F.col("next").alias("root"),
                                                             (F.col("next") != F.col("root")).alias("moved")), "hooks")
            if hook.filter("moved").isEmpty():
                break
        hook = hook.select("node", "root")
        if roots is None:
            roots = hook
        else:
            to = hook.select(F.col("node").alias("root"), F.col("root").alias("to"))
            roots = cut_lineage(roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")),
                                "roots")
        a, b = (hook.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "uv")
        edges = cut_lineage(edges.join(a, "u").join(b, "v").select(
            F.least("u_root", "v_root").alias("u"), F.greatest("u_root", "v_root").alias("v"))
            .filter("u < v").distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
