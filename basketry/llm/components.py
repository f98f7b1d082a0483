"""Distributed union-find: connected components of an edge table.

Every round hooks each node to its smallest neighbour, follows the hooks to their
roots by pointer jumping, and replaces the edges by those between roots. The
number of nodes that still have edges at least halves in a round. All steps are
joins and aggregations over edges; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.storage import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``: longs); the root is the component's smallest node.

    Loops and rows with a null say nothing; a node with nothing else does not occur.
    """
    live = scratch.cut(edges.select("a", "b").where("a <> b").distinct())
    found: DataFrame | None = None
    while not live.isEmpty():
        both = live.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            live.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        hooks = both.groupBy("node").agg(F.min("other").alias("least"))
        hooks = scratch.cut(hooks.select("node", F.least("node", "least").alias("root")))
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = scratch.cut(hooks.join(above, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = hooks
        else:
            later = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = scratch.cut(found.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
        one = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        two = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        next_edges = live.join(one, "a").join(two, "b").where("ra <> rb")
        live = scratch.cut(next_edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if found is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
