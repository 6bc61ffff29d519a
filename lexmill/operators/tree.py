"""Trees of parent pointers: depth, root, children and leaf paths, by doubling pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.scale import drop_stored, stored


def depths(nodes: DataFrame) -> DataFrame:
    """id, root, depth of nodes (id unique, parent). A parent that is null or unknown ends the way; nodes on a circle are left out.

    Each round every node jumps to where its ancestor points, so a chain of n takes log2 n rounds."""
    known = nodes.select(F.col("parent").alias("p")).join(nodes.select(F.col("id").alias("p")), "p", "left_semi").distinct().withColumn("ok", F.lit(True))
    at = stored(nodes.join(known, nodes["parent"] == known["p"], "left").select("id", F.when(F.col("ok"), F.col("parent")).alias("up"), F.when(F.col("ok"), 1).otherwise(0).cast("long").alias("depth"), F.when(F.col("ok").isNull(), F.col("id")).alias("root")))
    n = at.count()
    steps = 1
    while steps <= 2 * max(1, n) and not at.filter("root IS NULL").isEmpty():
        above = at.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("root").alias("r2"))
        new = stored(at.join(above, "up", "left").select("id", F.when(F.col("root").isNull(), F.col("up2")).alias("up"), F.when(F.col("root").isNull(), F.col("depth") + F.col("d2")).otherwise(F.col("depth")).alias("depth"), F.coalesce("root", "r2").alias("root")))
        drop_stored(at)
        at, steps = new, steps * 2
    return at.filter("root IS NOT NULL").select("id", "root", "depth")


def leaves(nodes: DataFrame) -> DataFrame:
    """Nodes that are nobody's parent."""
    return nodes.join(nodes.select(F.col("parent").alias("id")), "id", "left_anti")
