"""Connected components by labels that spread and shortcut, for links of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.scale import drop_stored, salted_lookup, stored


def components(links: DataFrame) -> DataFrame:
    """v, label: every record of links (a, b) with the smallest record linked to it directly or through others.

    Each round hangs every vertex's neighbours under the least of them and drops what it has hung (alternating large and small stars), so
    rounds grow with the logarithm of a chain's length. Rows of a vertex meet in an aggregation of minima first, which combines before
    the shuffle, and look the minimum up salted; nothing is collected. Links with a null side or of a record with itself are left out."""
    edges = stored(links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # large star: greater neighbours go under the least vertex of the neighbourhood
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stored(salted_lookup(both, least, "u", spread=F.col("v")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: smaller neighbours and the vertex itself go under the least of them
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = salted_lookup(large, low, "u", spread=F.col("v"))
        new = stored(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct())
        for t in (least, large, low):
            drop_stored(t)
        same = new.count() == edges.count() and new.exceptAll(edges).isEmpty()
        drop_stored(edges)
        edges = new
        if same:
            break
    roots = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_anti")
    return edges.select(F.col("u").alias("v"), F.col("v").alias("label")).union(roots.select("v", F.col("v").alias("label")))
