"""Vectors, rankings and curation arithmetic. The label of an embedding plays the room; its first value the score, its second the mark."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.operators import learn, search
from lexmill.plans.catalog import query
from lexmill.scale import table


def _vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))


_V = "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings"
_SCORED = f"SELECT vec_id, label, v[1] AS score, CASE WHEN v[2] > 0 THEN 1 ELSE 0 END AS y FROM ({_V})"


def _scored(spark, d):
    return _vectors(spark, d).select("vec_id", "label", F.element_at("v", 1).alias("score"), (F.element_at("v", 2) > 0).cast("int").alias("y"))


def _norm(c: str):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))


@query(f"SELECT vec_id, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm, v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))) AS first FROM ({_V})")
def l2_norm(spark, d):
    return _vectors(spark, d).withColumn("norm", _norm("v")).select("vec_id", "norm", (F.element_at("v", 1) / F.col("norm")).alias("first"))


@query(f"SELECT label, CAST(i AS INTEGER) AS dim, avg(x) AS mean FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM ({_V})) GROUP BY 1, 2")
def centroid_by_label(spark, d):
    return _vectors(spark, d).select("label", F.posexplode("v").alias("i", "x")).groupBy("label", (F.col("i") + 1).alias("dim")).agg(F.avg("x").alias("mean"))


@query(f"SELECT vec_id, CAST(i AS INTEGER) AS dim, x - avg(x) OVER (PARTITION BY label, i) AS centred FROM (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM ({_V}))")
def room_centred(spark, d):
    """Vectors less their room's mean: the means are aggregated and joined, so no window holds a whole room."""
    e = _vectors(spark, d).select("vec_id", "label", F.posexplode("v").alias("i", "x"))
    m = e.groupBy("label", "i").agg(F.avg("x").alias("m"))
    return e.join(m, ["label", "i"]).select("vec_id", (F.col("i") + 1).alias("dim"), (F.col("x") - F.col("m")).alias("centred"))


@query(f"""
    WITH v AS (SELECT vec_id, v FROM ({_V})), s AS (SELECT q.vec_id AS query, r.vec_id AS neighbour, list_cosine_similarity(q.v, r.v) AS c FROM v q, v r WHERE q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id), k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY c DESC, neighbour) AS rank FROM s)
    SELECT query, neighbour, rank, round(c, 6) AS similarity FROM k WHERE rank <= 10
""")
def cosine_topk(spark, d):
    """The ten nearest rows of every row whose id is divisible by 20, against all rows."""
    e = table(spark, d, "embeddings")
    return search.nearest(e, e.filter("vec_id % 20 = 0")).withColumn("similarity", F.round("similarity", 6))


@query(f"""
    WITH r AS (SELECT label, y, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS k FROM ({_SCORED}))
    SELECT label, avg(CASE WHEN k <= 5 THEN y END) AS p5, avg(CASE WHEN y = 1 THEN k END) AS mean_rank, sum(CASE WHEN k <= 10 THEN y / log2(k + 1.0) ELSE 0 END) / nullif((SELECT sum(1 / log2(i + 1.0)) FROM range(1, 11) t(i) WHERE i <= (SELECT sum(y) FROM r x WHERE x.label = r.label)), 0) AS ndcg10 FROM r GROUP BY label
""")
def ranking_metrics(spark, d):
    """Precision at 5, mean rank of the marked and NDCG at 10 of each room."""
    k = F.row_number().over(W.partitionBy("label").orderBy(F.desc("score"), "vec_id"))
    r = _scored(spark, d).withColumn("k", k)
    gain = 1 / F.log2(F.col("k") + 1.0)
    g = r.groupBy("label").agg(F.avg(F.when(F.col("k") <= 5, F.col("y"))).alias("p5"), F.avg(F.when(F.col("y") == 1, F.col("k"))).alias("mean_rank"), F.sum(F.when(F.col("k") <= 10, F.col("y") * gain).otherwise(0.0)).alias("dcg"), F.sum("y").cast("int").alias("n"))
    ideal = F.aggregate(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.least("n", F.lit(10)))).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))
    return g.select("label", "p5", "mean_rank", (F.col("dcg") / F.nullif(ideal, F.lit(0.0))).alias("ndcg10"))


@query(f"""
    WITH s AS (SELECT label, y, round(score, 1) AS score FROM ({_SCORED})), r AS (SELECT label, y, rank() OVER (PARTITION BY label ORDER BY score) + (count(*) OVER (PARTITION BY label, score) - 1) / 2.0 AS r FROM s),
    g AS (SELECT label, sum(CASE WHEN y = 1 THEN r ELSE 0 END) AS s, sum(y) AS p, count(*) - sum(y) AS n FROM r GROUP BY label) SELECT label, CASE WHEN p > 0 AND n > 0 THEN (s - p * (p + 1) / 2.0) / (p * n) END AS auc FROM g
""")
def label_auc(spark, d):
    return learn.auc(_scored(spark, d).withColumn("score", F.round("score", 1)), ["label"])


@query(f"SELECT vec_id FROM ({_SCORED}) WHERE label IN (SELECT label FROM ({_SCORED}) GROUP BY label HAVING max(y) = 1 AND min(y) = 0)")
def marked_rooms(spark, d):
    """Rows of rooms that have marks of both kinds."""
    s = _scored(spark, d)
    return s.join(s.groupBy("label").agg(F.max("y").alias("a"), F.min("y").alias("b")).filter("a = 1 AND b = 0").select("label"), "label", "left_semi").select("vec_id")


@query("SELECT vec_id, substr(sha1('blind:' || vec_id), 1, 6) AS blind, row_number() OVER (PARTITION BY label ORDER BY sha1('order:' || vec_id)) AS place FROM embeddings")
def blind_ids(spark, d):
    """Ids and places that tell nothing, from hashes of seeded names."""
    name = lambda p: F.sha1(F.concat_ws(":", F.lit(p), F.col("vec_id").cast("string")))
    return table(spark, d, "embeddings").select("vec_id", F.substring(name("blind"), 1, 6).alias("blind"), F.row_number().over(W.partitionBy("label").orderBy(name("order"))).alias("place"))


@query(f"""
    WITH s AS (SELECT label, vec_id, y, row_number() OVER (PARTITION BY label ORDER BY sha1('draw:' || vec_id)) AS k FROM ({_SCORED})) SELECT vec_id, row_number() OVER (ORDER BY k, label) AS place FROM s WHERE k <= 5
""")
def round_robin_draw(spark, d):
    """Five of each room by a seeded order, rooms by turns. The final numbering runs over the drawn rows only."""
    draw = F.sha1(F.concat_ws(":", F.lit("draw"), F.col("vec_id").cast("string")))
    s = _scored(spark, d).withColumn("k", F.row_number().over(W.partitionBy("label").orderBy(draw))).filter("k <= 5")
    return s.select("vec_id", F.row_number().over(W.orderBy("k", "label")).alias("place"))


@query("""
    WITH m AS (SELECT source, genre, ln(1 + n_chars) AS chars, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS en, CASE WHEN genre = 'story' THEN 1 ELSE 0 END AS story FROM documents WHERE n_chars IS NOT NULL) SELECT genre, avg(chars) AS chars, sum(en) AS en, sum(story) AS story, count(*) AS n FROM m GROUP BY genre
""")
def metadata_baseline(spark, d):
    """The features that need no vectors: one-hot columns and logarithms of sizes."""
    m = table(spark, d, "documents").filter("n_chars IS NOT NULL").select("genre", F.log1p("n_chars").alias("chars"), (F.col("lang") == "en").cast("int").alias("en"), (F.col("genre") == "story").cast("int").alias("story"))
    return m.groupBy("genre").agg(F.avg("chars").alias("chars"), F.sum(F.coalesce("en", F.lit(0))).alias("en"), F.sum(F.coalesce("story", F.lit(0))).alias("story"), F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS m, log2(count(*) / nullif(count(*) FILTER (WHERE event_type = 'click'), 0)) AS bits FROM events GROUP BY 1")
def curation_bits(spark, d):
    """Bits of choosing m of n."""
    g = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "click").alias("m"))
    return g.withColumn("bits", F.log2(F.col("n") / F.nullif(F.col("m"), F.lit(0))))


@query("""
    SELECT mix, source, weight, max_repeats, weight / sum(weight) OVER (PARTITION BY mix) AS share, sum(weight) OVER (PARTITION BY mix ORDER BY source) / sum(weight) OVER (PARTITION BY mix) AS upto FROM mix_weights WHERE weight > 0
""")
def shelf_shares(spark, d):
    """Shares and running shares of a mix's weights."""
    w = W.partitionBy("mix")
    m = table(spark, d, "mix_weights").filter("weight > 0")
    return m.select("mix", "source", "weight", "max_repeats", (F.col("weight") / F.sum("weight").over(w)).alias("share"), (F.sum("weight").over(w.orderBy("source")) / F.sum("weight").over(w)).alias("upto"))


@query("""
    WITH c AS (SELECT genre, count(*) AS v FROM documents WHERE genre IS NOT NULL GROUP BY 1), t AS (SELECT sum(v) * 0.5 AS target, sum(sqrt(v)) AS roots FROM c),
    o AS (SELECT genre, v, sum(v) OVER (ORDER BY v, genre ROWS UNBOUNDED PRECEDING) AS below, sum(sqrt(v)) OVER (ORDER BY v, genre ROWS UNBOUNDED PRECEDING) AS rb FROM c),
    s AS (SELECT *, lead(sqrt(v)) OVER (ORDER BY v, genre) AS next_root, (target - below) / nullif(roots - rb, 0) AS scale, (target) / roots AS s0, row_number() OVER (ORDER BY v, genre) AS k FROM o, t),
    pick AS (SELECT coalesce(min(scale) FILTER (WHERE scale >= sqrt(v) AND scale <= next_root), min(s0) FILTER (WHERE k = 1 AND s0 <= sqrt(v)), 1e18) AS scale FROM s)
    SELECT genre, v AS docs, least(CAST(v AS DOUBLE), pick.scale * sqrt(v)) AS quota FROM c, pick
""")
def quota_fractions(spark, d):
    """Temperature sampling: the scale s for which the sum of min(v, s sqrt(v)) is half of all, in closed form over sorted prefix sums.

    A genre is taken whole as long as s >= sqrt(v), so s lies between two neighbours of the sorted roots. The windows run over genres."""
    c = table(spark, d, "documents").filter("genre IS NOT NULL").groupBy("genre").agg(F.count("*").alias("v"))
    w = W.orderBy("v", "genre")
    t = c.agg((F.sum("v") * 0.5).alias("target"), F.sum(F.sqrt("v")).alias("roots"))
    o = c.select("genre", "v", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("below"), F.sum(F.sqrt("v")).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("rb"), F.lead(F.sqrt("v")).over(w).alias("next_root"), F.row_number().over(w).alias("k"))
    s = o.join(F.broadcast(t)).withColumn("scale", (F.col("target") - F.col("below")) / F.nullif(F.col("roots") - F.col("rb"), F.lit(0.0))).withColumn("s0", F.col("target") / F.col("roots"))
    pick = s.agg(F.coalesce(F.min(F.when((F.col("scale") >= F.sqrt("v")) & (F.col("scale") <= F.col("next_root")), F.col("scale"))), F.min(F.when((F.col("k") == 1) & (F.col("s0") <= F.sqrt("v")), F.col("s0"))), F.lit(1e18)).alias("scale"))
    return c.join(F.broadcast(pick)).select("genre", F.col("v").alias("docs"), F.least(F.col("v").cast("double"), F.col("scale") * F.sqrt("v")).alias("quota"))  # one row each


@query()
def permutation_pvalue(spark, d):
    """Whether the score tells the mark, by 200 seeded shuffles within rooms."""
    return learn.permutation_p(_scored(spark, d), "label", key="vec_id")
