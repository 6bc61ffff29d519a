"""Operators in their full definitions that no other query of the catalogue shows: choices, seats, spacing, live rows, ordered resolution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import layout
from lexmill.functions import text as X
from lexmill.operators import draw, lookup, near, sections, settle
from lexmill.plans.catalog import queries as _catalog
from lexmill.plans.catalog import query
from lexmill.plans.curation import _SETS, _common_headings, _HEADS
from lexmill.scale import salted_lookup, stored, table
from lexmill.sources import sinks
from lexmill.streaming import jobs

CHAIRS = ("view", "click", "purchase", "signup", "error")


@query("""
    WITH w AS (SELECT key, eligible AND words BETWEEN 60 AND 2000 AS fit, substr(sha256('7:' || shelf || ':' || key), 1, 12) < '199999999999' AS lot, coalesce(split = 'heldout', false) AS before, coalesce(note, '') <> '' AS rejected FROM works)
    SELECT key, coalesce(fit AND (lot OR before) AND NOT rejected, false) AS heldout FROM w
""")
def heldout_choice(spark, d):
    """The held-out choice in one: fit works drawn by lot or chosen before, less the rejected ones (those with a note)."""
    w = table(spark, d, "works")
    before, rejected = F.coalesce(F.col("split") == "heldout", F.lit(False)), F.coalesce("note", F.lit("")) != ""
    fit = F.col("eligible") & F.col("words").between(60, 2000)
    return w.select("key", F.coalesce(fit & (X.lot(F.concat_ws(":", F.lit("7"), "shelf", "key"), 0.1) | before) & ~rejected, F.lit(False)).alias("heldout"))


_chairs = "['" + "', '".join(CHAIRS) + "']"


@query(f"SELECT event_id AS turn, list_filter(list_concat(({_chairs})[(event_id - 1) % 5 + 1:], ({_chairs})[:(event_id - 1) % 5]), lambda c: c <> event_type)[1] AS seat FROM events")
def seats_by_turns(spark, d):
    """Chairs by turns, one of them down at each turn."""
    return draw.seats(table(spark, d, "events").select(F.col("event_id").alias("turn"), F.array("event_type").alias("down")), list(CHAIRS))


@query("SELECT event_id AS draw FROM events")
def pots_of_draws(spark, d):
    """Which of two pots each draw takes; the shares are tested."""
    return draw.two_pots(table(spark, d, "events").select(F.col("event_id").alias("draw")), 300, 200).filter("pot IN ('old', 'new')").select("draw")


@query("""
    WITH RECURSIVE l AS (SELECT path, generate_subscripts(ls, 1) AS n, unnest(ls) AS line FROM (SELECT path, string_split(text, chr(10)) AS ls FROM files WHERE text IS NOT NULL)),
    f AS (SELECT DISTINCT path, n FROM l WHERE regexp_matches(line, '^["“«]')), r(path, n) AS (SELECT path, min(n) FROM f GROUP BY path UNION ALL SELECT path, m FROM (SELECT r.path, (SELECT min(f.n) FROM f WHERE f.path = r.path AND f.n > r.n + 12) AS m FROM r) WHERE m IS NOT NULL)
    SELECT path, CAST(n AS INTEGER) AS n FROM r
""")
def spaced_findings(spark, d):
    """Lines of speech that don't stand within twelve lines of an earlier one that counts."""
    l = table(spark, d, "files").filter("text IS NOT NULL").select("path", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return settle.spaced(l.filter(F.col("line").rlike('^["“«]')).select("path", (F.col("i") + 1).alias("n")), "path", "n", 12)


@query("""
    WITH e AS (SELECT date_trunc('day', ts) AS snapshot, event_type AS prompt, count(*) AS n FROM events GROUP BY 1, 2) SELECT s.snapshot, p.prompt FROM (SELECT DISTINCT snapshot FROM e) s, (SELECT DISTINCT prompt FROM e) p WHERE (s.snapshot, p.prompt) NOT IN (SELECT (snapshot, prompt) FROM e WHERE n % 2 = 0)
""")
def unfinished_measures(spark, d):
    """Snapshots and prompts still to be measured: days and types, of which those with an even count are done."""
    e = table(spark, d, "events").groupBy(F.date_trunc("day", "ts").alias("snapshot"), F.col("event_type").alias("prompt")).agg(F.count("*").alias("n"))
    return lookup.unfinished(e.select("snapshot").distinct(), e.select("prompt").distinct(), e.filter("n % 2 = 0"))


@query("""
    WITH p AS (SELECT segment, num, list_distinct(hashes) AS nodes FROM docs), e AS (SELECT segment, num, -len(nodes) AS r, unnest(nodes) AS node FROM p), f AS (SELECT segment, node, arg_min(num, (r, num)) AS num FROM e GROUP BY segment, node)
    SELECT segment AS tree, num AS path, count(*) AS new FROM f GROUP BY 1, 2
""")
def first_seen_nodes(spark, d):
    """How many nodes each path adds to its tree, the longest path first (units as nodes, texts as paths)."""
    p = table(spark, d, "docs").select(F.col("segment").alias("tree"), F.col("num").alias("path"), F.array_distinct("hashes").alias("nodes"))
    return settle.first_seen_paths(p).select("tree", "path", F.size("new").alias("new"))


@query("SELECT doc_id, [{'tag': 'a', 'text': trim(coalesce(title, 'none'))}, {'tag': 'b', 'text': trim(coalesce(author, 'none'))}, {'tag': 'c', 'text': trim(coalesce(lang, 'none') || '</b>')}] AS parts FROM documents")
def tagged_parts(spark, d):
    """Segments of named tags: a second one of a name counts nothing, an unclosed one runs to the end."""
    c = lambda n: F.coalesce(n, F.lit("none"))
    t = F.concat(F.lit("x <a>"), c("title"), F.lit("</a> y <b>"), c("author"), F.lit("</b><a>"), c("genre"), F.lit("</a><c> "), c("lang"), F.lit("</b>"))
    return table(spark, d, "documents").select("doc_id", layout.inline_tags(t).alias("parts"))


@F.pandas_udf(T.IntegerType())
def _option(quote: pd.Series, options: pd.Series) -> pd.Series:
    return pd.Series([layout.quoted(q or "", [x or "" for x in o]) for q, o in zip(quote, options, strict=True)], dtype="Int32")


@query("""
    WITH q AS (SELECT doc_id, coalesce(title, '') AS t, coalesce(author, '') AS a, coalesce(genre, '') AS g, substr(coalesce(author, title, genre, 'x'), 2, 6) AS q FROM documents),
    n AS (SELECT *, CAST(contains(t, q) AS INTEGER) + CAST(contains(a, q) AS INTEGER) + CAST(contains(g, q) AS INTEGER) AS n FROM q)
    SELECT doc_id, CASE WHEN n = 1 THEN CASE WHEN contains(t, q) THEN 0 WHEN contains(a, q) THEN 1 ELSE 2 END END AS option FROM n WHERE q <> '' AND n > 0
""")
def quoted_options(spark, d):
    """Which of three fields a quotation is from; null where two hold it."""
    e = lambda n: F.coalesce(n, F.lit(""))
    q = F.substring(F.coalesce("author", "title", "genre", F.lit("x")), 2, 6)
    rows = table(spark, d, "documents").select("doc_id", q.alias("q"), F.array(e("title"), e("author"), e("genre")).alias("o")).filter((F.col("q") != "") & F.exists("o", lambda x: F.contains(x, F.col("q"))))
    return rows.select("doc_id", _option("q", "o").alias("option"))


@query("SELECT user_id, count(*) AS seen, array_to_string(list(event_type ORDER BY ts, event_id)[-5:], ',') AS recent FROM events GROUP BY user_id")
def stream_retold(spark, d):
    """A state told anew with every batch: how many rows a user has had and the last five types."""
    return jobs.run_updates(jobs.retold(jobs.read_events(spark, f"{d}/events.parquet*", files_per_trigger=1000)), "user_id")


@query("SELECT user_id, count(*) AS n, max(ts) AS last, max(ts) < (SELECT max(ts) FROM events) - INTERVAL 600 SECOND AS stale FROM events GROUP BY user_id")
def stream_partial_rows(spark, d):
    """Live rows overwritten by every batch, one for each user, stale after ten minutes of the stream's time."""
    return jobs.partial_rows(jobs.read_events(spark, f"{d}/events.parquet*", files_per_trigger=1000))


#: Steps from wiki markup to text, in this order, by patterns that every engine reads alike.
WIKI_STEPS = (
    (r"(?s)<!--.*?-->", ""), (r"(?is)<ref[^>/]*>.*?</ref>|<ref[^>]*/>", ""), (r"\{\{[^{}]*\}\}", ""), (r"(?s)\{\|.*?\|\}", ""), (r"(?i)\[\[(?:file|image|category):[^\]]*\]\]", ""), (r"\[\[[^\]|]*\|([^\]]*)\]\]", "1"),
    (r"\[\[([^\]]*)\]\]", "1"), (r"\[https?://[^\s\]]+ ([^\]]*)\]", "1"), (r"'{2,5}", ""), (r"(?m)^={2,6} *([^=\n]*[^=\n ]) *={2,6}[ \t]*$", "1"), (r"(?m)^[*#:;]+ *", ""), (r"</?[a-z]+[^<>]*>", ""),
)


def _wiki_sql(c: str) -> str:
    for pattern, to in WIKI_STEPS:
        to = "\\1" if to == "1" else to
        c = f"regexp_replace({c}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to}', 'g')"
    return c


@query(f"SELECT raw_path, md5({_wiki_sql('body')}) AS digest FROM raws WHERE body IS NOT NULL UNION ALL SELECT path, md5({_wiki_sql('text')}) FROM files WHERE text IS NOT NULL")
def wiki_to_text(spark, d):
    """Wiki markup stripped: comments, references, templates, tables, links, emphasis, headings, list signs, tags."""
    c = F.col("t")
    for pattern, to in WIKI_STEPS:
        c = F.regexp_replace(c, pattern, "$1" if to == "1" else to)
    rows = table(spark, d, "raws").select("raw_path", F.col("body").alias("t")).union(table(spark, d, "files").select("path", "text")).filter("t IS NOT NULL")
    return rows.select("raw_path", F.md5(c).alias("digest"))


@query(f"""
    WITH h AS (SELECT path, min(n) AS n, line FROM ({_HEADS}) GROUP BY path, line), k AS (SELECT line FROM h GROUP BY line HAVING count(*) BETWEEN 2 AND 12), m AS (SELECT h.* FROM h JOIN k USING (line)),
    p AS (SELECT x.path AS a, y.path AS b, x.line, x.n AS x, y.n AS y FROM m x JOIN m y ON x.line = y.line AND x.path < y.path)
    SELECT DISTINCT p.a, p.b FROM p JOIN p q ON p.a = q.a AND p.b = q.b AND p.line <> q.line AND abs(p.x - q.x) <= 3 AND abs(p.y - q.y) <= 3
""")
def adjacent_headings(spark, d):
    """Files with two common headings that stand within three lines of each other in both; a heading in more than twelve files is common by definition."""
    before = F.collect_list("y").over(W.partitionBy("a", "b").orderBy("x").rangeBetween(-3, -1))  # a line is one heading: three at most
    p = _common_headings(spark, d).withColumn("before", before)
    return p.filter(F.exists("before", lambda other: F.abs(other - F.col("y")) <= 3)).select("a", "b").distinct()


_WHO = "SELECT doc_id, coalesce(n_chars, 0) AS n, regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') AS slug, lower(author) AS who FROM documents WHERE title IS NOT NULL AND author IS NOT NULL"


@query(f"""
    WITH {_SETS}, m AS ({_WHO}), f AS (SELECT slug, who, arg_max(doc_id, (n, -doc_id)) AS best FROM m GROUP BY 1, 2), s AS (SELECT doc_id AS loser, best AS winner, 'metadata' AS why FROM m JOIN f USING (slug, who) WHERE doc_id <> best),
    j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, a.n AS na, b.n AS nb FROM r a JOIN r b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY ALL HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
    t AS (SELECT CASE WHEN (coalesce(x.n_chars, 0), -x.doc_id) < (coalesce(y.n_chars, 0), -y.doc_id) THEN a ELSE b END AS loser, CASE WHEN (coalesce(x.n_chars, 0), -x.doc_id) < (coalesce(y.n_chars, 0), -y.doc_id) THEN b ELSE a END AS winner, 'text' AS why FROM j JOIN documents x ON x.doc_id = a JOIN documents y ON y.doc_id = b)
    SELECT * FROM s UNION SELECT * FROM t
""")
def same_or_near(spark, d):
    """Documents that lose against a longer one of the same title and author, or against a near duplicate (of class representatives)."""
    docs = table(spark, d, "documents")
    m = docs.filter("title IS NOT NULL AND author IS NOT NULL").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n"), F.concat_ws("|", F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "-"), F.lower("author")).alias("who"))
    best = stored(m.groupBy("who").agg(F.max(F.struct("n", (-F.col("doc_id")).alias("neg"))).alias("b"), F.count("*").alias("c")).filter("c > 1").select("who", (-F.col("b.neg")).alias("winner")))
    same = salted_lookup(m, best, "who", spread=F.col("doc_id")).filter("doc_id <> winner").select(F.col("doc_id").alias("loser"), "winner", F.lit("metadata").alias("why"))
    sets = stored(near.shingle_sets(docs, "doc_id"))
    pairs = near.similar_pairs(sets.join(near.classes(sets).filter("key = class").select("key"), "key", "left_semi"))
    size = docs.select("doc_id", F.struct(F.coalesce("n_chars", F.lit(0)).alias("n"), (-F.col("doc_id")).alias("neg")).alias("s"))
    both = pairs.join(size.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a").join(size.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
    first = F.col("sa") < F.col("sb")
    return same.union(both.select(F.when(first, F.col("a")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("a")), F.lit("text"))).distinct()


@query(f"""
    WITH {_SETS}, p AS (SELECT a.doc_id AS small, b.doc_id AS large, count(*) AS s, a.n FROM r a JOIN r b ON a.e = b.e AND a.doc_id <> b.doc_id AND (a.n < b.n OR (a.n = b.n AND a.doc_id < b.doc_id)) GROUP BY ALL HAVING count(*) >= 0.8 * a.n)
    SELECT small AS doc_id, min(large) AS container FROM p GROUP BY small
""")
def contained_losers(spark, d):
    """Texts dropped as contained, the smaller first: whoever holds one is larger and comes later, so it stands as yet; with the first holder."""
    return _catalog()["pair_containment"](spark, d).groupBy(F.col("small").alias("doc_id")).agg(F.min("large").alias("container"))


@query("""
    WITH p AS (SELECT path, any_value(action) AS action, any_value(keep_units) AS keep FROM (SELECT DISTINCT path, action, keep_units FROM plan) GROUP BY path HAVING count(*) = 1),
    f AS (SELECT f.path, list_distinct(list_filter(hashes, lambda h: h <> 0)) AS u, list_distinct(list_filter(CASE WHEN action = 'drop' THEN [] WHEN action = 'keep' OR keep IS NULL THEN hashes ELSE flatten(list_transform(keep, lambda r: hashes[r[1] + 1:r[2]])) END, lambda h: h <> 0)) AS o FROM files f JOIN docs ON docs.num = f.doc JOIN p USING (path)),
    q AS (SELECT DISTINCT least(a.path, b.path) AS x, greatest(a.path, b.path) AS y FROM pairs WHERE a.path <> b.path)
    SELECT x, y, len(list_intersect(f.u, g.u)) AS shared, len(list_intersect(list_intersect(f.u, g.u), list_intersect(f.o, g.o))) AS survive FROM q JOIN f ON f.path = x JOIN f g ON g.path = y
""")
def surviving_residue(spark, d):
    """Of the units two matched files share, those that both still have after the plan."""
    p = table(spark, d, "plan").select("path", "action", "keep_units").distinct().groupBy("path").agg(F.count("*").alias("n"), F.first("action").alias("action"), F.first("keep_units").alias("keep")).filter("n = 1")
    f = table(spark, d, "files").select("path", "doc").join(table(spark, d, "docs").select(F.col("num").alias("doc"), "hashes"), "doc").join(p, "path")
    none = F.array().cast("array<long>")
    kept = F.when(F.col("action") == "drop", none).when((F.col("action") == "keep") | F.col("keep").isNull(), F.col("hashes")).otherwise(F.flatten(F.transform("keep", lambda r: F.slice("hashes", r[0] + 1, F.greatest(r[1] - r[0], F.lit(0))))))
    words = lambda c: F.array_distinct(F.filter(c, lambda h: h != 0))
    f = stored(f.select("path", words(F.col("hashes")).alias("u"), kept.alias("kept")).select("path", "u", words(F.col("kept")).alias("o")))
    q = table(spark, d, "pairs").filter("a.path <> b.path").select(F.least("a.path", "b.path").alias("x"), F.greatest("a.path", "b.path").alias("y")).distinct()
    name = lambda k: f.select(F.col("path").alias(k), F.struct("u", "o").alias(f"{k}_"))
    j = salted_lookup(salted_lookup(q, name("x"), "x", spread=F.col("y")), name("y"), "y", spread=F.col("x"))
    shared = F.array_intersect("x_.u", "y_.u")
    return j.select("x", "y", shared.alias("s"), F.array_intersect("x_.o", "y_.o").alias("o")).select("x", "y", F.size("s").alias("shared"), F.size(F.array_intersect("s", "o")).alias("survive"))


_MANIFEST = "md5(concat_ws('|', action, coalesce(reason, ''), CAST(coalesce(words_out, 0) AS VARCHAR)))"


@query(f"""
    WITH p AS (SELECT path, max(action) AS action, max(reason) AS reason, max(words_out) AS words_out FROM plan GROUP BY path), e AS (SELECT p.path, {_MANIFEST} AS k, f.size, f.mtime FROM p JOIN files f USING (path) WHERE action <> 'drop'),
    s AS (SELECT path, CASE WHEN size % 5 = 0 THEN 'other' ELSE {_MANIFEST} END AS k, CASE WHEN size % 7 = 0 THEN size + 1 ELSE size END AS size, mtime FROM p JOIN files f USING (path) WHERE size % 3 <> 0)
    SELECT coalesce(e.path, s.path) AS path, CASE WHEN e.path IS NULL THEN 'trash' WHEN s.path IS NULL OR s.k <> e.k OR s.size <> e.size OR s.mtime <> e.mtime THEN 'write' ELSE 'untouched' END AS step FROM e FULL OUTER JOIN s ON e.path = s.path
""")
def convergent_manifest(spark, d):
    """What an idempotent run has to do by plan key, size and time of every output: write, leave untouched, or move to the trash.

    The standing manifest is the expected one with every third output missing, every fifth key and every seventh size another."""
    p = table(spark, d, "plan").groupBy("path").agg(F.max("action").alias("action"), F.max("reason").alias("reason"), F.max("words_out").alias("words_out"))
    k = F.md5(F.concat_ws("|", "action", F.coalesce("reason", F.lit("")), F.coalesce("words_out", F.lit(0)).cast("string")))
    e = p.join(table(spark, d, "files").select("path", "size", "mtime"), "path").withColumn("key", k)
    size = F.when(F.col("size") % 7 == 0, F.col("size") + 1).otherwise(F.col("size"))
    manifest = lambda key, bytes_: F.concat_ws("|", key, bytes_.cast("string"), F.col("mtime").cast("string")).alias("plan_key")
    expected = e.filter("action <> 'drop'").select("path", manifest(F.col("key"), F.col("size")))
    standing = e.filter("size % 3 <> 0").select("path", manifest(F.when(F.col("size") % 5 == 0, "other").otherwise(F.col("key")), size))
    return sinks.convergent(expected, standing)


_APPARATUS = ", ".join("'" + x + "'" for x in sections.APPARATUS)


@query(f"""
    WITH m AS (SELECT source, doc_id, CASE WHEN lower(trim(title, ' ')) IN ({_APPARATUS}) OR doc_id % 11 = 0 THEN 'apparatus' WHEN len(regexp_split_to_array(text, '\\s+')) >= 30 THEN 'body' END AS strong FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
    z AS (SELECT *, min(CASE WHEN strong = 'body' THEN doc_id END) OVER (PARTITION BY source) AS lo, max(CASE WHEN strong = 'body' THEN doc_id END) OVER (PARTITION BY source) AS hi FROM m)
    SELECT source, doc_id, CASE WHEN doc_id < lo THEN 'front' WHEN doc_id > hi THEN 'back' ELSE 'body' END AS zone, coalesce(strong, CASE WHEN doc_id < lo THEN 'front' WHEN doc_id > hi THEN 'back' ELSE 'body' END) AS kind FROM z
""")
def section_zones(spark, d):
    """Parts of a book as front, body or back: sources as books, documents as their parts; every eleventh stands for apparatus."""
    docs = table(spark, d, "documents").filter("source IS NOT NULL AND text IS NOT NULL").select("source", "doc_id", "title", "text")
    title = F.when(F.col("doc_id") % 11 == 0, "Contents").otherwise(F.coalesce("title", F.lit("")))
    return sections.section_kinds(docs, "source", "doc_id", title, F.col("text")).select("source", "doc_id", "zone", "kind")


@query()
def fan_texts(spark, d):
    """Texts without header lines, notes and site marks of fan archives."""
    return settle.cleaned_fan_texts(table(spark, d, "files").filter("text IS NOT NULL"), "path")
