"""Connected components by joins: every node hooks on to its least neighbour, trees collapse, what is left is contracted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def _roots(hooks: DataFrame) -> DataFrame:
    """``hooks(node, label)`` with every label replaced by the root of its tree, by pointer jumping."""
    while True:
        up = hooks.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = stored(hooks.join(up, "label").select("node", F.col("up").alias("label"), (F.col("up") != F.col("label")).alias("moved")), "roots")
        hooks = new.drop("moved")
        if new.filter("moved").isEmpty():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; the label is the smallest node of the component.

    A round at least halves the nodes that still have links, and links that fall together or within a tree are gone after it, so
    the many links of a dense component are joined once. A node with very many links is one group of a minimum, combined before
    the shuffle. Each step is written to the shared folder.
    """
    def ends(one, other) -> list:
        return [F.least(one, other).alias("low"), F.greatest(one, other).alias("high")]

    edges = stored(links.filter("a <> b").select(*ends("a", "b")).distinct(), "edges")
    loops = links.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("label"))
    total = None
    while True:
        both = edges.union(edges.select("high", "low"))
        hooks = stored(both.groupBy(F.col("low").alias("node")).agg(F.min("high").alias("label")).select("node", F.least("node", "label").alias("label")), "hooks")
        step = _roots(hooks)
        if total is None:
            total = step
        else:
            then = step.select(F.col("node").alias("label"), F.col("label").alias("then"))
            total = stored(total.join(then, "label", "left").select("node", F.coalesce("then", "label").alias("label")), "labels")
        of_low, of_high = (step.select(F.col("node").alias(x), F.col("label").alias(f"{x}_label")) for x in ("low", "high"))
        apart = edges.join(of_low, "low").join(of_high, "high").filter("low_label <> high_label")
        edges = stored(apart.select(*ends("low_label", "high_label")).distinct(), "edges")
        if edges.isEmpty():
            return total.unionByName(loops).groupBy("node").agg(F.min("label").alias("label"))
