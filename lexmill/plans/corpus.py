"""Queries of the workbench over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.plans.catalog import query
from lexmill.scale import small, stored, table


@query(
    """
    WITH w AS (
      SELECT key, string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' ') AS ws FROM works WHERE split = 'heldout' AND text IS NOT NULL),
    d AS (
      SELECT doc_id, string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' ') AS ws FROM documents WHERE text IS NOT NULL),
    wl AS (SELECT key, list_filter(ws, lambda x: x <> '') AS ws FROM w),
    dl AS (SELECT doc_id, list_filter(ws, lambda x: x <> '') AS ws FROM d),
    wg AS (SELECT DISTINCT key, array_to_string(ws[i:i+7], ' ') AS g FROM wl, LATERAL (SELECT unnest(range(1, len(ws) - 6)) AS i)),
    dg AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+7], ' ') AS g FROM dl, LATERAL (SELECT unnest(range(1, len(ws) - 6)) AS i))
    SELECT key, doc_id, count(*) AS shared_runs FROM wg JOIN dg USING (g) GROUP BY key, doc_id HAVING count(*) >= 5
    """
)
def contamination_pairs(spark, d):
    """Held-out works x documents that share at least five distinct runs of eight words.

    Runs are hashed within the scan; the held-out side doesn't grow with the corpus, is counted and then broadcast, so a document's runs that
    hit nothing are gone before anything is shuffled."""

    def runs(df, key):
        words = df.filter("text IS NOT NULL").select(key, F.filter(F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), " "), lambda x: x != "").alias("w"))
        return words.select(key, F.explode_outer(F.array_distinct(X.hashed_runs(F.col("w"), 8))).alias("g")).filter("g IS NOT NULL")

    held = stored(runs(table(spark, d, "works").filter("split = 'heldout'"), "key"))
    return runs(table(spark, d, "documents"), "doc_id").join(small(held), "g").groupBy("key", "doc_id").agg(F.count("*").alias("shared_runs")).filter("shared_runs >= 5")
