"""Connected components of a table of links, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, from links (a, b).

    Each round gives a node the smallest root next to it, hands that on to the node's
    former root and follows roots to their own, so rounds grow with the logarithm of a
    component's diameter. Rounds are written tables; nothing is collected but a flag.
    """
    both = staged(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct(),
        "links",
    )
    roots = staged(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "roots")
    while True:
        near = both.join(roots.withColumnsRenamed({"node": "other", "root": "new"}), "other").select("node", "new")
        # a node's new root is also one for the node that was its root
        offered = near.groupBy("node").agg(F.min("new").alias("new"))
        hooked = (
            roots.join(offered, "node")
            .where("new < root")
            .select(F.explode(F.array("node", "root")).alias("node"), "new")
            .groupBy("node")
            .agg(F.min("new").alias("new"))
        )
        moved = roots.join(hooked, "node", "left").select("node", F.least("root", "new").alias("root"), "new")
        next_roots = staged(
            moved.alias("m")
            .join(moved.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left")
            .select("node", F.least("root", "above").alias("root")),
            "roots",
        )
        changed = next_roots.join(roots.withColumnRenamed("root", "old"), "node").where("root <> old")
        if changed.isEmpty():
            return next_roots
        roots = next_roots
