"""Union-find over a distributed link table, by hooking and contraction.

No node's links are gathered: each round takes one minimum per node (combined before the
shuffle), follows the pointers a few steps, and replaces the ends of each link by what they
point to, until no link joins two nodes. Nodes are ordered by a hash, so a chain of links
shrinks by a constant factor per round whatever ids it runs through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.sources.tables import release, written


def _follow(pointers: DataFrame) -> DataFrame:
    """Each node points to what its pointer points to."""
    onward = pointers.select(F.col("node").alias("up"), F.col("up").alias("onward"))
    return pointers.join(onward, "up").select("node", F.col("onward").alias("up"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node that links (a, b) join to another one.

    The root is a node of the component, the same for all of its nodes, not the smallest.
    Links with a null end or from a node to itself are ignored; repeated ones do no harm.
    """
    ranked = [F.struct(F.xxhash64(c).alias("rank"), F.col(c).alias("id")) for c in ("a", "b")]
    links = links.where("a <> b").select(
        F.least(*ranked).alias("a"), F.greatest(*ranked).alias("b")
    )
    links = written(links.distinct(), "links")
    roots = None
    while roots is None or not links.isEmpty():
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        first = written(pointers.withColumn("up", F.least("node", "up")), "pointers")
        pointers = written(_follow(_follow(first)), "pointers")
        release(first)
        before = roots
        if roots is None:
            roots = pointers.select("node", F.col("up").alias("root"))
        else:
            onward = pointers.select(F.col("node").alias("root"), "up")
            roots = roots.join(onward, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")
            )
        roots = written(roots, "roots")
        of_a = pointers.select(F.col("node").alias("a"), F.col("up").alias("new_a"))
        of_b = pointers.select(F.col("node").alias("b"), F.col("up").alias("new_b"))
        moved = links.join(of_a, "a").join(of_b, "b").where("new_a <> new_b")
        done = links
        links = written(moved.select(
            F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")
        ).distinct(), "links")
        # Only the roots and the links just written are read from here on.
        release(done, pointers, *([before] if before is not None else []))
    release(links)
    return roots.select(F.col("node.id").alias("node"), F.col("root.id").alias("root"))
