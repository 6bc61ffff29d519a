"""Verbatim lookup: which passages of query texts stand word for word in a corpus, and where."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.scale import small, stored

SIZE, SHOWN = 8, 5


def _runs(df: DataFrame, key: str, text: str, name: str, at: str, size: int) -> DataFrame:
    words = df.filter(F.col(text).isNotNull()).select(F.col(key).alias(name), F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("w")).filter(F.size("w") >= size)
    hashed = words.select(name, F.size("w").alias("n"), X.hashed_runs(F.col("w"), size).alias("r"))
    # an inner explode would be given a filter on the size of r, worked out anew below the words' column for every element
    return hashed.select(name, "n", F.posexplode_outer("r").alias(at, "h")).filter("h IS NOT NULL")


def lookup(queries: DataFrame, corpus: DataFrame, query: str = "key", doc: str = "doc_id", text: str = "text", size: int = SIZE, shown: int = SHOWN) -> tuple[DataFrame, DataFrame]:
    """(spans, scores). spans: query, from_word, words, doc, doc_from, rank for the `shown` longest places of each maximal span; scores: query,
    words, covered, score: the share of a query's words in verified spans of at least `size` words.

    A span is a run of places at which the offset between query and document stays the same, so it is verified word by word through its
    overlapping runs. Runs of the query side are looked up in the corpus; corpus rows that hit nothing leave before the shuffle if the query
    side is small enough to be broadcast. How many places a span has stays exact; only the list shown is limited."""
    q = stored(_runs(queries, query, text, "q", "i", size))
    hits = _runs(corpus, doc, text, "d", "j", size).select("d", "j", "h").join(small(q), "h")
    offset = hits.select("q", "n", "d", "i", "j", (F.col("i") - F.col("j")).alias("o")).distinct()
    w = W.partitionBy("q", "d", "o").orderBy("i")
    island = offset.withColumn("g", F.col("i") - F.row_number().over(w))
    spans = stored(island.groupBy("q", "n", "d", "o", "g").agg(F.min("i").alias("i0"), F.max("i").alias("i1"), F.min("j").alias("j0")).select("q", "n", "d", F.col("i0").alias("from_word"), (F.col("i1") - F.col("i0") + size).alias("words"), F.col("j0").alias("doc_from")))
    ranked = spans.withColumn("rank", F.row_number().over(W.partitionBy("q", "from_word").orderBy(F.desc("words"), "d", "doc_from"))).filter(F.col("rank") <= shown)
    covered = spans.select("q", "n", F.explode(F.sequence("from_word", F.col("from_word") + F.col("words") - 1)).alias("p")).distinct().groupBy("q", "n").agg(F.count("*").alias("covered"))
    total = q.select("q", "n").distinct()
    scores = total.join(covered.select("q", "covered"), "q", "left").select(F.col("q").alias(query), (F.col("n")).alias("words"), F.coalesce("covered", F.lit(0)).alias("covered"))
    return ranked.select(F.col("q").alias(query), "from_word", "words", F.col("d").alias(doc), "doc_from", "rank"), scores.withColumn("score", F.col("covered") / F.col("words"))


def unfinished(snapshots: DataFrame, prompts: DataFrame, done: DataFrame, snapshot: str = "snapshot", prompt: str = "prompt") -> DataFrame:
    """Snapshot and prompt pairs still to be measured, the newest snapshot first. prompts is a short list and is sent to every snapshot."""
    todo = snapshots.select(snapshot).join(small(stored(prompts.select(prompt))))
    return todo.join(done.select(snapshot, prompt), [snapshot, prompt], "left_anti").orderBy(F.desc(snapshot), prompt)
