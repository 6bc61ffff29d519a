"""Views over append-only ledgers and event streams, as batch queries; lexmill.streaming has the incremental forms.

Tumbling, sliding and session windows and the late-row rule are additions of this engine; the count windows, the latest-state views and the
change digest follow the stream store."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.plans.catalog import query
from lexmill.scale import carried, numbered, table


def _events(spark, d):
    return table(spark, d, "events")


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, d):
    return _events(spark, d).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query("""
    WITH e AS (SELECT time_bucket(INTERVAL 30 minute, ts) - k * INTERVAL 30 minute AS start, value FROM events, (VALUES (0), (1)) t(k)) SELECT start, count(*) AS n, max(value) AS top FROM e GROUP BY 1
""")
def events_sliding(spark, d):
    return _events(spark, d).groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("top")).select(F.col("w.start").alias("start"), "n", "top")


@query("""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 hour THEN 0 ELSE 1 END AS cut, event_id FROM events),
    s AS (SELECT user_id, ts, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 hour AS finish, count(*) AS n FROM s GROUP BY user_id, k
""")
def events_session(spark, d):
    """Sessions that a gap of two hours ends."""
    return _events(spark, d).groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("finish"), "n")


@query("""
    WITH l AS (SELECT max(ts) AS now FROM events) SELECT user_id, max(ts) AS last_ok, CASE WHEN date_diff('second', max(ts), now) <= 3600 THEN 'alive' WHEN date_diff('second', max(ts), now) <= 86400 THEN 'lagging' ELSE 'stale' END AS state FROM events, l GROUP BY user_id, now
""")
def liveness(spark, d):
    """Age bands of each user's last event, by the newest event of all."""
    e = _events(spark, d)
    now = e.agg(F.max("ts").alias("now"))  # one row
    last = e.groupBy("user_id").agg(F.max("ts").alias("last_ok")).join(F.broadcast(now))
    age = F.unix_timestamp("now") - F.unix_timestamp("last_ok")
    return last.select("user_id", "last_ok", F.when(age <= 3600, "alive").when(age <= 86400, "lagging").otherwise("stale").alias("state"))


@query("""
    WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)
    SELECT user_id, CAST(ceil(k / 20.0) AS BIGINT) AS batch, count(*) AS n, round(sum(value), 2) AS total, count(*) = 20 AS full_batch FROM r GROUP BY 1, 2
""")
def batch_of_n(spark, d):
    """Tumbling count batches of 20, oldest first, the last one partial."""
    e = numbered(_events(spark, d).select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"]).withColumn("batch", F.ceil(F.col("k") / 20.0))
    return e.groupBy("user_id", "batch").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).withColumn("full_batch", F.col("n") == 20)


@query("""
    SELECT event_id, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 9 PRECEDING) AS mean10, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 9 PRECEDING) AS n FROM events
""")
def window_of_n(spark, d):
    """A sliding count window: the last ten up to each event."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-9, 0)
    return _events(spark, d).select("event_id", F.avg("value").over(w).alias("mean10"), F.count("*").over(w).alias("n"))


@query("""
    WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id FROM r WHERE k <= 16 AND n >= 16
""")
def newest_window(spark, d):
    """The newest 16 of each user, all or none; the backlog is let go."""
    w = W.partitionBy("user_id")
    r = _events(spark, d).select("user_id", "event_id", F.row_number().over(w.orderBy(F.desc("ts"), F.desc("event_id"))).alias("k"), F.count("*").over(w).alias("n"))
    return r.filter("k <= 16 AND n >= 16").select("user_id", "event_id")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS mark, max(ts) AS at FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id")
def latest_mark(spark, d):
    """Exclusive marks, the last write wins."""
    e = _events(spark, d).filter(F.col("event_type").isin("click", "view", "purchase"))
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("mark"), F.max("ts").alias("at"))


@query("""
    WITH r AS (SELECT event_id, ts, max(ts) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events) SELECT event_id, seen IS NOT NULL AND ts < seen - INTERVAL 10 minute AS late FROM r
""")
def late_events(spark, d):
    """Rows that come, in order of arrival, more than ten minutes behind what their user has sent already."""
    seen = F.max("ts").over(W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1))
    return _events(spark, d).withColumn("seen", seen).select("event_id", F.coalesce(F.col("ts") < F.col("seen") - F.expr("INTERVAL 10 MINUTES"), F.lit(False)).alias("late"))


@query("""
    SELECT p.event_id, c.event_id AS click FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1) c ON p.user_id = c.user_id AND p.ts >= c.ts
""")
def as_of_join(spark, d):
    """The newest click up to each purchase: both kinds in one order, the last click carried on, over ranges of a user's rows where there are many."""
    e = _events(spark, d).filter(F.col("event_type").isin("purchase", "click")).select("user_id", "ts", F.when(F.col("event_type") == "click", 0).otherwise(1).alias("late"), "event_id")
    last = carried(e, ["user_id"], ["ts", "late", "event_id"], F.when(F.col("late") == 0, F.col("event_id")), "click")
    return last.filter("late = 1").select("event_id", "click")


@query("""
    SELECT a.event_id AS error_id, b.event_id AS view_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 15 minute WHERE a.event_type = 'error' AND b.event_type = 'view'
""")
def interval_join(spark, d):
    """Views within 15 minutes behind an error of the same user; time cells of that width keep a busy user's rows apart."""
    cell = lambda c: F.floor(F.unix_timestamp(c) / 900)
    e = _events(spark, d)
    a = e.filter("event_type = 'error'").select(F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("t0"), F.explode(F.array(cell("ts"), cell("ts") + 1)).alias("cell"))
    b = e.filter("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("t1"), cell("ts").alias("cell"))
    return a.join(b, ["user_id", "cell"]).filter(F.col("t1").between(F.col("t0"), F.col("t0") + F.expr("INTERVAL 15 MINUTES"))).select("error_id", "view_id")


@query("""
    WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, avg(value) AS v FROM events GROUP BY 1, 2),
    m AS (SELECT *, avg(v) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS m0, avg(v) OVER (w ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING) AS m1, avg(v) OVER (w ROWS BETWEEN 8 PRECEDING AND 6 PRECEDING) AS m2, abs(v - lag(v) OVER w) AS step, row_number() OVER w AS k FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)),
    b AS (SELECT *, greatest(0.004, 1.5 * median(step) OVER (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING)) AS band FROM m)
    SELECT event_type, day, m0, band, CASE WHEN k < 6 THEN 'new' WHEN m0 < m1 - band THEN 'learning' WHEN k >= 9 AND m0 > m1 + band AND m1 > m2 THEN 'turned' WHEN m0 > m1 + band THEN 'rising' ELSE 'flat' END AS verdict FROM b
""")
def running_mean_trend(spark, d):
    """A trend detector: means of the last, the previous and the earlier three points, against a band of the usual step."""
    days = _events(spark, d).groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.avg("value").alias("v"))
    w = W.partitionBy("event_type").orderBy("day")
    m = days.select("*", F.avg("v").over(w.rowsBetween(-2, 0)).alias("m0"), F.avg("v").over(w.rowsBetween(-5, -3)).alias("m1"), F.avg("v").over(w.rowsBetween(-8, -6)).alias("m2"), F.abs(F.col("v") - F.lag("v").over(w)).alias("step"), F.row_number().over(w).alias("k"))
    steps = F.array_sort(F.filter(F.collect_list("step").over(w.rowsBetween(W.unboundedPreceding, 0)), lambda x: x.isNotNull()))
    n = F.size("steps")
    at = lambda i: F.element_at("steps", i.cast("int"))
    mid = F.when(n == 0, None).otherwise((at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2)
    b = m.withColumn("steps", steps).withColumn("band", F.greatest(F.lit(0.004), 1.5 * mid))
    up, down = F.col("m0") > F.col("m1") + F.col("band"), F.col("m0") < F.col("m1") - F.col("band")
    verdict = F.when(F.col("k") < 6, "new").when(down, "learning").when((F.col("k") >= 9) & up & (F.col("m1") > F.col("m2")), "turned").when(up, "rising").otherwise("flat")
    return b.select("event_type", "day", "m0", "band", verdict.alias("verdict"))


@query("""
    WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, avg(value) AS v FROM events GROUP BY 1, 2), u AS (SELECT *, v > lag(v) OVER (PARTITION BY event_type ORDER BY day) AS up FROM d),
    g AS (SELECT *, sum(CASE WHEN up THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY day) AS island FROM u)
    SELECT event_type, island, min(day) AS start, count(*) AS days FROM g WHERE up GROUP BY 1, 2 HAVING count(*) >= 2
""")
def confirmed_runs(spark, d):
    """Two or more rises running: gaps and islands."""
    days = _events(spark, d).groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.avg("value").alias("v"))
    w = W.partitionBy("event_type").orderBy("day")
    u = days.withColumn("up", F.coalesce(F.col("v") > F.lag("v").over(w), F.lit(False)))
    g = u.withColumn("island", F.sum(F.when(F.col("up"), 0).otherwise(1)).over(w))
    return g.filter("up").groupBy("event_type", "island").agg(F.min("day").alias("start"), F.count("*").alias("days")).filter("days >= 2")


@query("""
    SELECT event_type, arg_min(event_id, (value, event_id)) AS at_least, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1
""")
def series_ends(spark, d):
    order = F.struct("ts", "event_id")
    return _events(spark, d).groupBy("event_type").agg(F.min_by("event_id", F.struct("value", "event_id")).alias("at_least"), F.min_by("value", order).alias("first_value"), F.max_by("value", order).alias("last_value"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def props_json(spark, d):
    return _events(spark, d).select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("""
    SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'error') AS error, count(*) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1
""")
def events_pivot(spark, d):
    return _events(spark, d).groupBy("user_id").pivot("event_type", ["click", "error", "view"]).count().fillna(0)


@query("SELECT event_type, extract(hour FROM ts) AS hour, count(*) AS n FROM events GROUP BY CUBE (event_type, extract(hour FROM ts))")
def event_cube(spark, d):
    return _events(spark, d).select("event_type", F.hour("ts").cast("long").alias("hour")).cube("event_type", "hour").agg(F.count("*").alias("n"))


@query("""
    WITH o AS (SELECT user_id, md5(string_agg(event_id || ':' || event_type, ',' ORDER BY event_id)) AS h FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1), n AS (SELECT user_id, md5(string_agg(event_id || ':' || event_type, ',' ORDER BY event_id)) AS h FROM events GROUP BY 1)
    SELECT n.user_id, o.user_id IS NULL AS is_new FROM n LEFT JOIN o USING (user_id) WHERE o.h IS DISTINCT FROM n.h
""")
def change_digest(spark, d):
    """Users whose visible state moved since a snapshot: a digest for each key, order-independent, against the earlier one."""
    digest = lambda e: e.groupBy("user_id").agg(F.bit_xor(F.xxhash64("event_id", "event_type")).alias("x"), F.count("*").alias("c"))
    e = _events(spark, d)
    old = digest(e.filter("ts < TIMESTAMP '2024-01-15'")).select("user_id", F.struct("x", "c").alias("h"))
    new = digest(e).select("user_id", F.struct("x", "c").alias("n"))
    return new.join(old, "user_id", "left").filter(~F.col("n").eqNullSafe(F.col("h"))).select("user_id", F.col("h").isNull().alias("is_new"))


@query("""
    WITH w AS (SELECT max(event_id) AS mark FROM events WHERE event_type = 'signup') SELECT event_id FROM events, w WHERE event_id > mark
""")
def past_watermark(spark, d):
    """What a consumer has not covered: rows behind the greatest one it has put out."""
    e = _events(spark, d)
    mark = e.filter("event_type = 'signup'").agg(F.max("event_id").alias("mark"))
    return e.join(F.broadcast(mark), F.col("event_id") > F.col("mark")).select("event_id")  # the mark is one row


@query("""
    WITH p AS (SELECT event_id FROM events WHERE event_type <> 'error' AND event_id < (SELECT max(event_id) FROM events) - 200 ORDER BY event_id DESC LIMIT 51), r AS (SELECT event_id, row_number() OVER (ORDER BY event_id DESC) AS k FROM p)
    SELECT event_id, (SELECT count(*) FROM p) > 50 AS more FROM r WHERE k <= 50
""")
def keyset_page(spark, d):
    """A page of 50, newest first, before a key; flagged rows hidden; whether there is more."""
    e = _events(spark, d)
    before = e.agg((F.max("event_id") - 200).alias("before"))
    page = e.join(F.broadcast(before), F.col("event_id") < F.col("before")).filter("event_type <> 'error'").select("event_id").orderBy(F.desc("event_id")).limit(51)
    k = F.row_number().over(W.orderBy(F.desc("event_id")))  # at most 51 rows
    return page.select("event_id", k.alias("k"), (F.count("*").over(W.partitionBy()) > 50).alias("more")).filter("k <= 50").select("event_id", "more")


@query("""
    WITH g AS (SELECT user_id, date_trunc('day', ts) AS day, min(event_id) AS first_id FROM events GROUP BY 1, 2), n AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY first_id) AS chapter FROM g)
    SELECT e.event_id, n.chapter, row_number() OVER (PARTITION BY e.user_id, n.day ORDER BY e.event_id) AS verse FROM events e JOIN n ON e.user_id = n.user_id AND date_trunc('day', e.ts) = n.day
""")
def chapter_verse(spark, d):
    """Chapters by first-seen day, verses within them."""
    e = _events(spark, d).withColumn("day", F.date_trunc("day", "ts"))
    n = e.groupBy("user_id", "day").agg(F.min("event_id").alias("first_id")).withColumn("chapter", F.dense_rank().over(W.partitionBy("user_id").orderBy("first_id"))).drop("first_id")
    return e.join(n, ["user_id", "day"]).select("event_id", "chapter", F.row_number().over(W.partitionBy("user_id", "day").orderBy("event_id")).alias("verse"))


@query("""
    WITH r AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) SELECT user_id, CAST(ceil(k / 4.0) AS BIGINT) AS session, min(ts) AS start, max(ts) AS finish, count(*) AS turns, count(*) = 4 AS closed FROM r GROUP BY 1, 2
""")
def sessions_of_four(spark, d):
    """Sessions closed by a cap of turns, whatever the gaps."""
    e = numbered(_events(spark, d).select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"]).withColumn("session", F.ceil(F.col("k") / 4.0))
    return e.groupBy("user_id", "session").agg(F.min("ts").alias("start"), F.max("ts").alias("finish"), F.count("*").alias("turns")).withColumn("closed", F.col("turns") == 4)


@query("""
    WITH v AS (SELECT user_id, max(CASE WHEN event_type = 'view' THEN ts END) AS last_view, min(CASE WHEN event_type = 'signup' THEN ts END) AS signed FROM events GROUP BY 1) SELECT user_id, last_view, signed, date_diff('second', signed, last_view) AS span FROM v
""")
def newest_of_kinds(spark, d):
    v = _events(spark, d).groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "view", F.col("ts"))).alias("last_view"), F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("signed"))
    return v.select("*", (F.unix_timestamp("last_view") - F.unix_timestamp("signed")).alias("span"))


@query("""
    WITH t AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'), done AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10')
    SELECT user_id, min(event_id) AS oldest FROM t WHERE user_id NOT IN (SELECT user_id FROM done) GROUP BY 1
""")
def pending_oldest(spark, d):
    """In the time window, not yet produced: the oldest of each."""
    e = _events(spark, d)
    t = e.filter("event_type = 'view' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
    done = e.filter("event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10'").select("user_id").distinct()
    return t.join(done, "user_id", "left_anti").groupBy("user_id").agg(F.min("event_id").alias("oldest"))


@query("""
    WITH g AS (SELECT user_id, min(event_id) AS f, max(CASE WHEN event_type = 'signup' THEN event_id END) AS have FROM events WHERE ts < TIMESTAMP '2024-01-03' GROUP BY 1), m AS (SELECT coalesce(max(have), 0) AS top FROM g)
    SELECT user_id, CASE WHEN have IS NOT NULL THEN have ELSE top + row_number() OVER (PARTITION BY have IS NULL ORDER BY f) END AS number FROM g, m
""")
def backfill_numbers(spark, d):
    """Standing numbers are kept; the rest get the next ones in first-seen order."""
    g = _events(spark, d).filter("ts < TIMESTAMP '2024-01-03'").groupBy("user_id").agg(F.min("event_id").alias("f"), F.max(F.when(F.col("event_type") == "signup", F.col("event_id"))).alias("have"))
    top = g.agg(F.coalesce(F.max("have"), F.lit(0)).alias("top"))
    k = numbered(g.withColumn("open", F.col("have").isNull()), ["open"], ["f"])
    return k.join(F.broadcast(top)).select("user_id", F.coalesce("have", F.col("top") + F.col("k")).alias("number"))  # one row
