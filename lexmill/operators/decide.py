"""Order-dependent decisions without groups: which of overlapping documents are dropped, cut or kept.

A document is decided by its higher-ranked neighbours that were not dropped themselves. It can be decided as soon as all of those are, so
whole layers are decided at once by joins and sums; the rounds are as many as the longest chain of ever higher-ranked overlapping
documents, and no component is ever gathered in one task."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.scale import drop_stored, salted_lookup, stored


def decide(nodes: DataFrame, overlaps: DataFrame, whole: Column) -> DataFrame:
    """id, fate (keep, cut, drop), covered: words of id in units that a surviving higher-ranked document has.

    nodes: id, rank (unique, greater is higher), words, reference (neither acts nor is acted upon). overlaps: low, high, unit, words, for
    every unit of low that high holds; rows whose high isn't higher-ranked are left out. whole: whether a document is dropped whole, over
    the columns words and covered. Null or unknown ids take no part; repeated rows count once."""
    nodes = stored(nodes.select("id", "rank", "words", F.coalesce("reference", F.lit(False)).alias("reference")).filter("id IS NOT NULL").dropDuplicates(["id"]))
    acting = nodes.filter("NOT reference").select("id", "rank")
    o = overlaps.select("low", "high", "unit", F.col("words").alias("w")).distinct()
    o = o.join(acting.select(F.col("id").alias("low"), F.col("rank").alias("rl")), "low").join(acting.select(F.col("id").alias("high"), F.col("rank").alias("rh")), "high").filter("rh > rl")
    o = stored(o.select("low", "high", "unit", "w"))
    done = stored(nodes.join(o.select(F.col("low").alias("id")).distinct(), "id", "left_anti").select("id", F.lit("keep").alias("fate"), F.lit(0).cast("long").alias("covered")))
    waiting = stored(o.select(F.col("low").alias("id")).distinct())
    while not waiting.isEmpty():
        mine = o.join(waiting.select(F.col("id").alias("low")), "low", "left_semi").join(done.select(F.col("id").alias("high"), "fate"), "high", "left")
        ready = mine.groupBy("low").agg(F.count_if(F.col("fate").isNull()).alias("open")).filter("open = 0").select("low")
        units = mine.join(ready, "low", "left_semi").groupBy("low", "unit").agg(F.max("w").alias("w"), F.max(F.col("fate") != "drop").alias("held"))
        sums = units.groupBy(F.col("low").alias("id")).agg(F.sum(F.when(F.col("held"), F.col("w")).otherwise(0)).cast("long").alias("covered")).join(nodes, "id")
        now = stored(sums.select("id", F.when(F.col("covered") == 0, "keep").when(whole, "drop").otherwise("cut").alias("fate"), "covered"))
        new_done, new_waiting = stored(done.union(now)), stored(waiting.join(now, "id", "left_anti"))
        for t in (done, waiting, now):
            drop_stored(t)
        done, waiting = new_done, new_waiting
    return done


def decide_units(nodes: DataFrame, holdings: DataFrame, whole: Column) -> DataFrame:
    """As decide, with overlaps given by units (id, unit, words) instead of pairs: whoever has a unit overlaps with all others that have it.

    Of a unit only the highest-ranked holder not yet decided counts. If it stays, all others that wait have the unit covered and the unit is
    closed; if it is dropped, the next one takes its place. So units of any number of holders make no pairs, and a unit that many share is
    settled as soon as its first holder is, not in as many rounds as it has holders."""
    nodes = stored(nodes.select("id", "rank", "words", F.coalesce("reference", F.lit(False)).alias("reference")).filter("id IS NOT NULL").dropDuplicates(["id"]))
    acting = nodes.filter("NOT reference").select("id", "rank")
    held = stored(holdings.filter("unit IS NOT NULL").groupBy("id", "unit").agg(F.max("words").alias("w")).join(acting, "id"))
    common = stored(held.groupBy("unit").agg(F.count("*").alias("c")).filter("c > 1").select("unit"))
    rows = stored(salted_lookup(held, common, "unit", spread=F.col("id")).select("unit", "id", "rank", "w"))
    waiting = stored(rows.select("id").distinct().withColumn("covered", F.lit(0).cast("long")))
    done = [stored(nodes.join(waiting, "id", "left_anti").select("id", F.lit("keep").alias("fate"), F.lit(0).cast("long").alias("covered")))]
    for t in (held, common):
        drop_stored(t)
    while not waiting.isEmpty():
        tops = stored(rows.groupBy("unit").agg(F.max("rank").alias("top")))
        behind = salted_lookup(rows, tops, "unit", spread=F.col("id")).filter("rank < top").select("id").distinct()
        fate = F.when(F.col("covered") == 0, "keep").when(whole, "drop").otherwise("cut")
        now = stored(waiting.join(behind, "id", "left_anti").join(nodes, "id").select("id", fate.alias("fate"), "covered"))
        closed = stored(rows.join(now.filter("fate <> 'drop'"), "id", "left_semi").select("unit", F.lit(True).alias("closed")).distinct())
        marked = stored(salted_lookup(rows.join(now, "id", "left_anti"), closed, "unit", "left", spread=F.col("id")))
        gains = marked.filter("closed").groupBy("id").agg(F.sum("w").cast("long").alias("gain"))
        new_waiting = stored(waiting.join(now, "id", "left_anti").join(gains, "id", "left").select("id", (F.col("covered") + F.coalesce("gain", F.lit(0))).alias("covered")))
        for t in (waiting, tops, closed, rows):
            drop_stored(t)
        done.append(now)
        waiting, rows = new_waiting, marked.filter("closed IS NULL").drop("closed")
    return functools.reduce(DataFrame.union, done)
