"""Queries through the operators that SQL can't express, and the streaming forms of the event views."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions import layout
from lexmill.functions import text as X
from lexmill.operators import draw, near, sections
from lexmill.plans.catalog import query
from lexmill.scale import table
from lexmill.streaming import jobs


def _stream(spark, d):
    return jobs.read_events(spark, f"{d}/events.parquet*", files_per_trigger=1000)


@query("""
    SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 hour, any_value(ts)) + INTERVAL 1 hour <= (SELECT max(ts) FROM events) - INTERVAL 10 minute
""")
def stream_tumbling(spark, d):
    """Windows that the watermark has closed, put out once."""
    return jobs.run_once(jobs.tumbling(_stream(spark, d))).withColumn("total", F.round("total", 2))


@query("""
    WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) SELECT user_id, CAST(ceil(k / 20.0) AS BIGINT) AS batch, count(*) AS n, round(sum(value), 2) AS total FROM r GROUP BY 1, 2 HAVING count(*) = 20
""")
def stream_count_windows(spark, d):
    return jobs.run_once(jobs.count_windows(_stream(spark, d))).withColumn("total", F.round("total", 2))


@query("""
    WITH r AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) SELECT user_id, CAST(ceil(k / 4.0) AS BIGINT) AS session, min(ts) AS start, max(ts) AS finish, count(*) AS turns FROM r GROUP BY 1, 2 HAVING count(*) = 4
""")
def stream_turn_sessions(spark, d):
    return jobs.run_once(jobs.turn_sessions(_stream(spark, d)))


@query("SELECT event_id, event_type FROM events")
def stream_without_repeats(spark, d):
    return jobs.run_once(jobs.without_repeats(_stream(spark, d)).select("event_id", "event_type"))


@query("""
    SELECT a.event_id AS a_id, b.event_id AS b_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 15 minute WHERE a.event_type = 'error' AND b.event_type = 'view'
""")
def stream_interval_join(spark, d):
    return jobs.run_once(jobs.followed(_stream(spark, d)))


@query("SELECT mix, draw FROM (SELECT DISTINCT mix FROM mix_weights WHERE weight > 0), range(1, 2001) t(draw)")
def mixture_draws(spark, d):
    """Two thousand seeded draws from each mix; which source a draw takes is tested for its shares."""
    out = None
    sizes = {r["source"]: r["n"] for r in table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n")).collect()}  # one row for each source
    weights: dict[str, dict[str, float]] = {}
    for r in table(spark, d, "mix_weights").filter("weight > 0").collect():
        weights.setdefault(r["mix"], {})[r["source"]] = r["weight"]
    for seed, (mix, w) in enumerate(sorted(weights.items())):
        m = draw.mixture(spark.range(1, 2001).withColumnRenamed("id", "draw"), w, {s: max(1, sizes.get(s, 1)) for s in w}, seed=seed).select(F.lit(mix).alias("mix"), "draw")
        out = m if out is None else out.unionByName(m)
    return out


@query("SELECT round, count(*) AS n FROM (SELECT DISTINCT doc_id FROM documents), range(1, 4) t(round) GROUP BY round")
def shuffle_bag_rounds(spark, d):
    """Three rounds of a bag in which every document comes once a round; drawn within sources, so no task holds a whole round."""
    return draw.shuffle_bag(table(spark, d, "documents"), 3, "doc_id", ["source"]).groupBy("round").agg(F.count("*").alias("n"))


@query("SELECT path, len(string_split(text, chr(10))) AS lines FROM files WHERE text IS NOT NULL")
def story_parts(spark, d):
    """Texts split at headings and put together again: the lines are all there."""
    p = sections.story_split(table(spark, d, "files"), "path").filter("whole")
    return p.groupBy("path").agg(F.sum(F.size(F.split("text", "\n"))).alias("lines"))


@query()
def edge_walk(spark, d):
    return sections.edges(table(spark, d, "files").filter("text <> ''"), "path")


@query()
def book_sections(spark, d):
    return sections.sections(table(spark, d, "files").filter("text <> ''"), "path")


@query()
def unwrapped_texts(spark, d):
    return table(spark, d, "files").filter("text <> ''").select("path", layout.unwrap_lines("text").alias("text"))


@query()
def norm_word_counts(spark, d):
    """Words for comparison of each text, beside what the index counts."""
    f = table(spark, d, "files").filter("text <> ''").select(F.col("doc").alias("num"), F.size(layout.norm_tokens("text")).alias("words")).dropDuplicates(["num"])
    return f.join(table(spark, d, "docs").select("num", "codes"), "num")


@query()
def mended_breaks(spark, d):
    """Texts whose broken words were mended by the corpus's own vocabulary."""
    english = F.lower(F.element_at(F.split(F.trim("lang"), "[-_]"), 1)) == "en"  # EN, en-EN; of null the language isn't known
    docs = table(spark, d, "documents").filter(F.col("text").isNotNull() & english).select("doc_id", "text")
    # a word of the vocabulary stands somewhere outside runs of short pieces, or in five runs: else the pieces of a broken word would be words
    count = lambda c: docs.select(F.explode(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    outside = count(F.regexp_replace("text", layout.BROKEN_RUN, " ")).select("word", F.lit(True).alias("free"))
    vocabulary = count(F.col("text")).join(outside, "word", "left").filter("free OR n >= 5").drop("free")
    return layout.mended(docs, vocabulary, out="mended").filter("mended <> text").select("doc_id", "mended")


@query("""
    WITH RECURSIVE l AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line, len(ls) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
    o AS (SELECT doc_id, line, i, n, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - CASE WHEN i = n THEN 1 ELSE 0 END AS upto FROM l),
    b AS (SELECT doc_id, max(upto) AS total, list(upto ORDER BY upto) FILTER (WHERE i < n AND regexp_matches(line, '^[ \\t\\r]*\\z')) AS blanks FROM o GROUP BY doc_id),
    c(doc_id, k, pos, upto) AS (SELECT doc_id, 1, CAST(0 AS HUGEINT), coalesce(list_filter(blanks, lambda x: x >= 500 AND x < total)[1], total) FROM b
      UNION ALL SELECT c.doc_id, k + 1, c.upto, coalesce(list_filter(blanks, lambda x: x >= c.upto + 500 AND x < total)[1], total) FROM c JOIN b ON b.doc_id = c.doc_id WHERE c.upto < total)
    SELECT c.doc_id, k AS chunk, CAST(pos AS BIGINT) AS start, md5(substr(text, CAST(pos + 1 AS BIGINT), CAST(upto - pos AS BIGINT))) AS digest FROM c JOIN documents d ON d.doc_id = c.doc_id
""")
def chunked_texts(spark, d):
    """Chunks of at least 500 characters, cut behind blank lines: number, first character and digest of each."""
    c = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", layout.chunks("text", F.lit(500)).alias("c")).select("doc_id", F.posexplode("c").alias("i", "chunk"))
    before = F.sum(F.length("chunk")).over(W.partitionBy("doc_id").orderBy("i").rowsBetween(W.unboundedPreceding, -1))
    return c.select("doc_id", (F.col("i") + 1).alias("chunk"), F.coalesce(before, F.lit(0)).alias("start"), F.md5("chunk").alias("digest"))


@query()
def minhash_signatures(spark, d):
    """Signatures of 64 least hashes over runs of eight words."""
    w = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("w")).filter("size(w) >= 8")
    h = w.select("doc_id", X.hashed_runs(F.col("w"), 8).alias("h"))
    return h.select("doc_id", near.minhash("h").alias("signature"))
