"""Connected components of a link table, entirely on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tables


def _some(df: DataFrame) -> bool:
    return bool(df.head(1))


def compress(forest: DataFrame) -> DataFrame:
    """Every node of the forest (node, root) pointed at its root, by pointer doubling."""
    while True:
        up = forest.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = tables.keep(forest.join(up, "root", "left").select(
            "node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "jump")
        forest = jumped.select("node", "root")
        if not _some(jumped.where("moved")):
            return forest


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node that is not the smallest of its component.

    ``links`` has two columns ``a`` and ``b`` (any direction, repeats allowed).
    Each round every node hooks to its smallest smaller neighbour, chains are
    compressed and the links are carried over to the roots, so the table shrinks
    fast whatever the shape.  A hub's links are pre-aggregated (``min``) before
    the shuffle; nothing is collected.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    left, hooks = tables.keep(ordered(links), "links"), None
    while _some(left):
        hooked = compress(tables.keep(left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "hooks"))
        hooks = hooked if hooks is None else hooks.unionByName(hooked)
        to = hooked.select(F.col("node"), F.col("root"))
        moved = (left.join(to.withColumnRenamed("node", "a"), "a").select(F.col("root").alias("a"), "b")
                 .join(to.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("root", "b").alias("b")))
        left = tables.keep(ordered(moved), "links")
    return compress(hooks) if hooks is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
