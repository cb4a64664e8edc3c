"""Connected components of a link table, in rounds of joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable, itself included.

    Each round hooks every component to the smallest one next to it, follows the
    hooks twice, and contracts the links; a round at least halves the number of components that have
    links left. Minima are partial sums per task, so a hub node is no hot key.
    """
    start = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    left, hooks = start, []
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("to"))
        hook = stored(hook, "hooks")
        for _ in range(2):
            on = hook.select(F.col("a").alias("to"), F.col("to").alias("next"))
            hook = hook.join(on, "to", "left").select("a", F.coalesce("next", "to").alias("to"))
        hook = stored(hook, "hooks")
        hooks.append(hook)
        at_b = hook.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        left = stored(
            left.join(hook, "a").join(at_b, "b").where("to <> to_b")
            .select(F.least("to", "to_b").alias("a"), F.greatest("to", "to_b").alias("b")).distinct(), "links",
        )
    nodes = start.select(F.col("a").alias("node")).union(start.select("b")).distinct().withColumn("component", F.col("node"))
    for hook in hooks:
        nodes = nodes.join(hook.withColumnRenamed("a", "component"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return nodes


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The links that join two parts not yet joined, in the given order."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept
