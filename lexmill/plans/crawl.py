"""The crawl ledger, listings of files, fetched pages and sinks' manifests."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.plans.catalog import query
from lexmill.scale import numbered, table

_LONG_AGO = "TIMESTAMP '1900-01-01 00:00:00'"
_STATE = f"(coalesce(updated, {_LONG_AGO}), coalesce(attempts, 0), coalesce(status, ''))"


def _order():
    return F.struct(F.coalesce("updated", F.expr(_LONG_AGO)).alias("u"), F.coalesce("attempts", F.lit(0)).alias("a"), F.coalesce("status", F.lit("")).alias("s"))


@query(f"SELECT source, url, arg_max(status, {_STATE}) AS status, max(attempts) AS attempts, max(updated) AS updated, count(*) AS states FROM jobs GROUP BY 1, 2")
def ledger_latest(spark, d):
    """The last state of each job; rows without a time count as oldest."""
    j = table(spark, d, "jobs").groupBy("source", "url")
    return j.agg(F.max_by("status", _order()).alias("status"), F.max("attempts").alias("attempts"), F.max("updated").alias("updated"), F.count("*").alias("states"))


@query("SELECT source, url, min(updated) AS first_seen, arg_min(kind, updated) AS kind FROM jobs WHERE updated IS NOT NULL GROUP BY 1, 2")
def ledger_first(spark, d):
    return table(spark, d, "jobs").filter("updated IS NOT NULL").groupBy("source", "url").agg(F.min("updated").alias("first_seen"), F.min_by("kind", "updated").alias("kind"))


@query(f"""
    SELECT source, url, arg_max(json_extract_string(metadata, '$.title'), {_STATE}) FILTER (WHERE json_extract_string(metadata, '$.title') IS NOT NULL) AS title,
      arg_max(json_extract_string(metadata, '$.language'), (coalesce(updated, {_LONG_AGO}), coalesce(attempts, 0), coalesce(status, ''), json_extract_string(metadata, '$.language'))) FILTER (WHERE json_extract_string(metadata, '$.language') <> '') AS language FROM jobs GROUP BY 1, 2
""")
def ledger_merged(spark, d):
    """Metadata of all states of a job merged key by key, the newest that has the key wins."""
    j = table(spark, d, "jobs").withColumn("t", F.get_json_object("metadata", "$.title")).withColumn("l", F.get_json_object("metadata", "$.language")).withColumn("o", _order())
    return j.groupBy("source", "url").agg(F.max_by(F.col("t"), F.when(F.col("t").isNotNull(), F.col("o"))).alias("title"), F.max(F.when(F.col("l") != "", F.struct("o", "l")))["l"].alias("language"))


@query("""
    WITH p AS (SELECT DISTINCT id, source, url, kind FROM jobs WHERE status = 'pending'), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE kind WHEN 'index' THEN 0 ELSE 1 END, id, url) AS k FROM p) SELECT source, id, url FROM r WHERE k = 1
""")
def queue_next(spark, d):
    """The next job of each source: index pages first, then by id."""
    p = table(spark, d, "jobs").filter("status = 'pending'").select("id", "source", "url", "kind").distinct()
    rank = F.struct(F.when(F.col("kind") == "index", 0).otherwise(1).alias("r"), "id", "url")
    return p.groupBy("source").agg(F.min(rank).alias("m")).select("source", "m.id", "m.url")


@query("""
    SELECT DISTINCT url, lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1)) || regexp_replace(regexp_replace(url, '^[a-zA-Z]+://[^/?#]*', ''), '#.*$', '') AS canonical FROM jobs WHERE url IS NOT NULL
""")
def url_canonical(spark, d):
    """Scheme and host in lower case, no fragment."""
    head = F.lower(F.regexp_extract("url", "^([a-zA-Z]+://[^/?#]*)", 1))
    return table(spark, d, "jobs").filter("url IS NOT NULL").select("url").distinct().select("url", F.concat(head, F.regexp_replace(F.regexp_replace("url", "^[a-zA-Z]+://[^/?#]*", ""), "#.*$", "")).alias("canonical"))


@query("SELECT regexp_extract(lower(coalesce(final_url, url)), '^[a-z]+://([^/?#:]*)', 1) AS host, count(DISTINCT url) AS urls, count(*) AS states FROM jobs GROUP BY 1")
def url_host_counts(spark, d):
    host = F.regexp_extract(F.lower(F.coalesce("final_url", "url")), "^[a-z]+://([^/?#:]*)", 1)
    return table(spark, d, "jobs").groupBy(host.alias("host")).agg(F.countDistinct("url").alias("urls"), F.count("*").alias("states"))


@query("SELECT source, kind, status, count(DISTINCT id) AS jobs, coalesce(sum(words), 0) AS words FROM jobs GROUP BY 1, 2, 3")
def jobs_by_status(spark, d):
    return table(spark, d, "jobs").groupBy("source", "kind", "status").agg(F.countDistinct("id").alias("jobs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))


@query("SELECT f.path, sha256(f.text) AS id, d.num IS NOT NULL AS indexed FROM files f LEFT JOIN docs d ON d.id = sha256(f.text) WHERE f.text <> ''")
def content_address(spark, d):
    """Files by the digest of their text, and whether that text is indexed already."""
    f = table(spark, d, "files").filter("text <> ''").select("path", F.sha2("text", 256).alias("id"))
    return f.join(table(spark, d, "docs").select("id", "num"), "id", "left").select("path", "id", F.col("num").isNotNull().alias("indexed"))


@query("""
    SELECT path, CASE WHEN text IS NULL THEN 'unreadable' WHEN text = '' THEN 'empty' WHEN contains(text, chr(65533)) THEN 'not utf-8' WHEN len(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) < 20 THEN 'no words' WHEN size > 67108864 THEN 'too large' END AS reason FROM files
""")
def quarantine(spark, d):
    """Why a file is put aside; null for good ones."""
    t = F.col("text")
    reason = F.when(t.isNull(), "unreadable").when(t == "", "empty").when(t.contains("�"), "not utf-8").when(F.regexp_count(t, F.lit(r"[\p{L}\p{N}]+")) < 20, "no words").when(F.col("size") > 67108864, "too large")
    return table(spark, d, "files").select("path", reason.alias("reason"))


@query("""
    WITH k AS (SELECT text_path AS path, epoch_ns(max(updated)) AS seen, arg_max(words, updated) AS words FROM jobs WHERE text_path IS NOT NULL AND status = 'done' GROUP BY 1), f AS (SELECT path, mtime, d.words FROM files LEFT JOIN docs d ON d.num = files.doc)
    SELECT coalesce(f.path, k.path) AS path, CASE WHEN f.path IS NULL THEN 'vanished' WHEN k.path IS NULL THEN 'new' WHEN seen IS NULL OR mtime > seen OR k.words IS DISTINCT FROM f.words THEN 'changed' ELSE 'same' END AS change FROM f FULL OUTER JOIN k ON f.path = k.path
""")
def listing_changes(spark, d):
    """A listing against what the ledger's last done row knows: new, changed, same and vanished in one outer join.

    A file is the same if it wasn't written to after that row and has as many words as it says."""
    k = table(spark, d, "jobs").filter("text_path IS NOT NULL AND status = 'done'").groupBy(F.col("text_path").alias("path")).agg(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', max(updated)) * 1000").alias("seen"), F.max_by("words", "updated").alias("were"), F.lit(True).alias("known"))
    words = table(spark, d, "docs").select(F.col("num").alias("doc"), "words")
    f = table(spark, d, "files").select("path", "mtime", "doc").join(words, "doc", "left").withColumn("listed", F.lit(True))
    new = F.col("seen").isNull() | (F.col("mtime") > F.col("seen")) | ~F.col("were").eqNullSafe(F.col("words"))
    change = F.when(F.col("listed").isNull(), "vanished").when(F.col("known").isNull(), "new").when(new, "changed").otherwise("same")
    return f.join(k, "path", "full_outer").select("path", change.alias("change"))


@query("WITH n AS (SELECT max(mtime) AS now FROM files) SELECT path FROM files, n WHERE mtime <= now - 90000000000")
def settled_files(spark, d):
    """Files that haven't been written to for 90 seconds, by the newest time of the listing."""
    f = table(spark, d, "files").select("path", "mtime")
    now = f.agg(F.max("mtime").alias("now"))
    return f.join(F.broadcast(now), F.col("mtime") <= F.col("now") - 90 * 1_000_000_000).select("path")  # one row


@query("SELECT path FROM files WHERE path NOT IN (SELECT path FROM plan WHERE path IS NOT NULL)")
def unplanned_files(spark, d):
    return table(spark, d, "files").select("path").join(table(spark, d, "plan").select("path"), "path", "left_anti")


@query("""
    WITH l AS (SELECT raw_path, unnest(regexp_extract_all(body, 'href="([^"]*)"', 1)) AS href FROM raws WHERE body IS NOT NULL) SELECT raw_path, href, count(*) AS n, min(regexp_extract(href, '^[a-z]+://([^/?#]*)', 1)) AS host FROM l GROUP BY 1, 2
""")
def page_links(spark, d):
    r = table(spark, d, "raws").filter("body IS NOT NULL").select("raw_path", F.explode(F.regexp_extract_all("body", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    return r.groupBy("raw_path", "href").agg(F.count("*").alias("n"), F.min(F.regexp_extract("href", "^[a-z]+://([^/?#]*)", 1)).alias("host"))


@query("""
    SELECT r.raw_path, nullif(regexp_extract(body, '<title>([^<|]*)', 1), '') AS title, regexp_extract(body, '(?i)charset=["'']?([a-z0-9-]+)', 1) AS charset, len(regexp_extract_all(body, '<p[ >]')) AS paragraphs, j.words AS declared
    FROM raws r LEFT JOIN (SELECT raw_path, max(words) AS words FROM jobs WHERE raw_path IS NOT NULL GROUP BY 1) j ON j.raw_path = r.raw_path WHERE body IS NOT NULL
""")
def page_meta(spark, d):
    """What a page says of itself beside what the ledger says of it."""
    j = table(spark, d, "jobs").filter("raw_path IS NOT NULL").groupBy("raw_path").agg(F.max("words").alias("declared"))
    r = table(spark, d, "raws").filter("body IS NOT NULL")
    r = r.select("raw_path", F.nullif(F.regexp_extract("body", "<title>([^<|]*)", 1), F.lit("")).alias("title"), F.regexp_extract("body", "(?i)charset=[\"']?([a-z0-9-]+)", 1).alias("charset"), F.regexp_count("body", F.lit("<p[ >]")).alias("paragraphs"))
    return r.join(j, "raw_path", "left")


#: Steps from HTML to text by patterns that every engine reads alike.
HTML_STEPS = ((r"(?is)<(?:script|style|head)[^>]*>.*?</(?:script|style|head)>", " "), (r"(?i)<br ?/?>|</(?:p|div|h[1-6]|li)>", "\n"), (r"<[^>]+>", ""), (r"&nbsp;", " "), (r"&lt;", "<"), (r"&gt;", ">"), (r"&quot;", '"'), (r"&amp;", "&"), (r"[ \t]+", " "), (r" ?\n[ \n]*", "\n"))


def _html_sql(c: str) -> str:
    for pattern, to in HTML_STEPS:
        to = {"\n": "chr(10)"}.get(to, f"'{to}'")
        c = f"regexp_replace({c}, '{pattern}', {to}, 'g')"
    return c


@query(f"SELECT raw_path, trim({_html_sql('body')}, ' ') AS text FROM raws WHERE body IS NOT NULL")
def html_to_text(spark, d):
    c = F.col("body")
    for pattern, to in HTML_STEPS:
        c = F.regexp_replace(c, pattern, to)
    return table(spark, d, "raws").filter("body IS NOT NULL").select("raw_path", F.trim(c).alias("text"))


@query("""
    SELECT raw_path, CASE WHEN regexp_matches(body, '(?i)<!doctype html|<html|<p[ >]') THEN 'html' WHEN regexp_matches(body, '\\\\(?:begin|chapter|section|emph|textbf)[{*]') THEN 'tex' WHEN regexp_matches(body, '\\[\\[|\\{\\{|''''''|(?m)^==') THEN 'wiki' ELSE 'text' END AS kind,
      content_type IS NULL AS undeclared FROM raws WHERE body IS NOT NULL
""")
def sniffed_kinds(spark, d):
    """The kind of a page by its content; the declared type may be missing or wrong."""
    b = F.col("body")
    kind = F.when(b.rlike("(?i)<!doctype html|<html|<p[ >]"), "html").when(b.rlike(r"\\(?:begin|chapter|section|emph|textbf)[{*]"), "tex").when(b.rlike(r"\[\[|\{\{|'''|(?m)^=="), "wiki").otherwise("text")
    return table(spark, d, "raws").filter("body IS NOT NULL").select("raw_path", kind.alias("kind"), F.col("content_type").isNull().alias("undeclared"))


_PARTS = "regexp_extract(text, '^([^\\n]*?) *[(][0-9]+/[0-9]+[)]', 1) AS base, CAST(nullif(regexp_extract(text, '^[^\\n]*?[(]([0-9]+)/[0-9]+[)]', 1), '') AS INTEGER) AS part, CAST(nullif(regexp_extract(text, '^[^\\n]*?[(][0-9]+/([0-9]+)[)]', 1), '') AS INTEGER) AS parts"


def _parts(spark, d):
    t = table(spark, d, "documents").filter("text IS NOT NULL")
    n = lambda p: F.nullif(F.regexp_extract("text", p, 1), F.lit("")).cast("int")
    rows = t.select("doc_id", "source", "author", "text", F.regexp_extract("text", r"^([^\n]*?) *[(][0-9]+/[0-9]+[)]", 1).alias("base"), n(r"^[^\n]*?[(]([0-9]+)/[0-9]+[)]").alias("part"), n(r"^[^\n]*?[(][0-9]+/([0-9]+)[)]").alias("parts"))
    return rows.filter("part IS NOT NULL AND parts BETWEEN 1 AND 999")


@query(f"""
    WITH p AS (SELECT doc_id, source, text, {_PARTS} FROM documents WHERE text IS NOT NULL), q AS (SELECT * FROM p WHERE part IS NOT NULL AND parts BETWEEN 1 AND 999),
    o AS (SELECT source, base, part, min((doc_id, text)) AS one FROM q GROUP BY 1, 2, 3)
    SELECT source, base, min(one[1]) AS doc_id, count(*) AS parts, md5(string_agg(one[2], chr(10) ORDER BY part)) AS digest FROM o GROUP BY 1, 2
""")
def multipart_merge(spark, d):
    """Texts that are part n of m, joined in order under their base title; of repeated parts the first stands."""
    one = _parts(spark, d).groupBy("source", "base", "part").agg(F.min(F.struct("doc_id", "text")).alias("one"))
    # a base title has at most as many parts as its pages say
    whole = one.groupBy("source", "base").agg(F.min("one.doc_id").alias("doc_id"), F.count("*").alias("parts"), F.array_sort(F.collect_list(F.struct("part", "one.text"))).alias("t"))
    return whole.select("source", "base", "doc_id", "parts", F.md5(F.array_join(F.transform("t", lambda x: x["text"]), "\n")).alias("digest"))


@query(f"""
    WITH p AS (SELECT source, {_PARTS} FROM documents WHERE text IS NOT NULL), g AS (SELECT source, base, max(parts) AS n, list_distinct(list(part)) AS have FROM p WHERE part IS NOT NULL AND parts BETWEEN 1 AND 999 GROUP BY 1, 2)
    SELECT source, base, n, list_sort(list_filter(range(1, n + 1), lambda i: NOT list_contains(have, i))) AS missing FROM g WHERE len(list_filter(range(1, n + 1), lambda i: NOT list_contains(have, i))) > 0
""")
def missing_parts(spark, d):
    g = _parts(spark, d).groupBy("source", "base").agg(F.max("parts").alias("n"), F.collect_set("part").alias("have"))
    return g.select("source", "base", "n", F.array_sort(F.array_except(F.sequence(F.lit(1), F.col("n")), "have")).alias("missing")).filter("size(missing) > 0")


@query("""
    SELECT id, source || '-' || lpad(CAST(row_number() OVER (PARTITION BY source ORDER BY id) AS VARCHAR), 4, '0') AS number FROM (SELECT DISTINCT id, source FROM jobs)
""")
def running_ids(spark, d):
    return numbered(table(spark, d, "jobs").select("id", "source").distinct(), ["source"], ["id"]).select("id", F.concat_ws("-", "source", F.lpad(F.col("k").cast("string"), 4, "0")).alias("number"))


@query("""
    WITH a AS (SELECT path, md5(coalesce(text, '')) AS h, size FROM files), b AS (SELECT DISTINCT path, action, CASE WHEN action = 'keep' THEN doc END AS h FROM plan)
    SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'write' WHEN a.path IS NULL OR b.action = 'drop' THEN 'trash' WHEN b.action = 'keep' THEN 'untouched' ELSE 'write' END AS step FROM a FULL OUTER JOIN (SELECT DISTINCT path, action FROM b) b ON a.path = b.path
""")
def convergent_writes(spark, d):
    """What an idempotent run has to do: expected against standing manifest."""
    b = table(spark, d, "plan").select("path", "action").distinct()
    a = table(spark, d, "files").select("path").withColumn("here", F.lit(True))
    step = F.when(F.col("action").isNull(), "write").when(F.col("here").isNull() | (F.col("action") == "drop"), "trash").when(F.col("action") == "keep", "untouched").otherwise("write")
    return a.join(b, "path", "full_outer").select("path", step.alias("step"))


@query("SELECT shelf, sha256(string_agg(name || ':' || sha256(text), ';' ORDER BY name)) AS digest, count(*) AS works FROM works WHERE text IS NOT NULL GROUP BY shelf")
def shelf_digest(spark, d):
    """A digest of a shelf's contents in order of names; the shelf's entries are digests, not texts."""
    w = table(spark, d, "works").filter("text IS NOT NULL").select("shelf", "name", F.concat_ws(":", "name", F.sha2("text", 256)).alias("e"))
    g = w.groupBy("shelf").agg(F.array_sort(F.collect_list(F.struct("name", "e"))).alias("a"), F.count("*").alias("works"))
    return g.select("shelf", F.sha2(F.array_join(F.transform("a", lambda x: x["e"]), ";"), 256).alias("digest"), "works")


@query("""
    SELECT shelf, coalesce(split, 'none') AS split, count(*) AS works, sum(words) AS words, sum(tokens) AS tokens, sum(words) / sum(sum(words)) OVER (PARTITION BY shelf) AS share FROM works GROUP BY 1, 2
""")
def shelf_summary(spark, d):
    g = table(spark, d, "works").groupBy("shelf", F.coalesce("split", F.lit("none")).alias("split")).agg(F.count("*").alias("works"), F.sum("words").alias("words"), F.sum("tokens").alias("tokens"))
    return g.withColumn("share", F.col("words") / F.sum("words").over(W.partitionBy("shelf")))


@query("""
    WITH a AS (SELECT shelf, unnest(authors) AS author, words FROM works), g AS (SELECT shelf, author, count(*) AS works, sum(words) AS words FROM a GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY shelf ORDER BY words DESC, author) AS k FROM g) SELECT shelf, author, works, words FROM r WHERE k <= 8
""")
def top_authors(spark, d):
    g = table(spark, d, "works").select("shelf", F.explode("authors").alias("author"), "words").groupBy("shelf", "author").agg(F.count("*").alias("works"), F.sum("words").alias("words"))
    k = F.row_number().over(W.partitionBy("shelf").orderBy(F.desc("words"), "author"))
    return g.withColumn("k", k).filter("k <= 8").drop("k")


@query("""
    SELECT f.path, coalesce(j.status, 'none') AS status, s.kind, json_extract_string(j.metadata, '$.title') AS title FROM files f LEFT JOIN (SELECT text_path, arg_max(status, (attempts, id, status)) AS status, arg_max(metadata, (attempts, id, status)) AS metadata FROM jobs WHERE text_path IS NOT NULL AND attempts IS NOT NULL AND metadata IS NOT NULL GROUP BY 1) j ON j.text_path = f.path
    LEFT JOIN sources s ON s.name = f.source
""")
def files_with_metadata(spark, d):
    """Files with what the ledger and the sources know of them; missing entries stay."""
    j = table(spark, d, "jobs").filter("text_path IS NOT NULL AND attempts IS NOT NULL AND metadata IS NOT NULL")
    o = F.struct("attempts", "id", "status")
    j = j.groupBy(F.col("text_path").alias("path")).agg(F.max_by("status", o).alias("status"), F.max_by("metadata", o).alias("metadata"))
    s = table(spark, d, "sources").select(F.col("name").alias("source"), "kind")
    return table(spark, d, "files").select("path", "source").join(j, "path", "left").join(F.broadcast(s), "source", "left").select("path", F.coalesce("status", F.lit("none")).alias("status"), "kind", F.get_json_object("metadata", "$.title").alias("title"))  # sources: 26 rows
