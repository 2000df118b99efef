"""Connected components of an edge table, wholly distributed.

Each round every node hooks to its smallest neighbour (a map-side combined
minimum), the hooks are doubled until all point to the root of their tree, and
the edges are contracted: an edge inside a tree goes, equal edges merge. Each
round leaves half the nodes at most, until no edge is left. Joins are on plain
keys, so AQE splits a node with many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (u, v); root is some node of its component."""
    now = checkpointed(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    hooks = []
    while not now.isEmpty():
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to")).withColumnRenamed("u", "node")
        while True:
            hook = checkpointed(hook)
            far = hook.join(hook.select(F.col("node").alias("to"), F.col("to").alias("far")), "to")
            if far.where("far <> to").isEmpty():
                break
            hook = far.select("node", F.col("far").alias("to"))
        hooks.append(hook)
        a = hook.select(F.col("node").alias("u"), F.col("to").alias("a"))
        b = hook.select(F.col("node").alias("v"), F.col("to").alias("b"))
        met = now.join(a, "u").join(b, "v").where("a <> b")
        now = checkpointed(met.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if not hooks:
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = hooks[0].withColumnRenamed("to", "root")
    for hook in hooks[1:]:
        out = out.join(hook.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return out
