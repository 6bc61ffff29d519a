"""Filters, predicates and features of texts (documents, files, works)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.plans.catalog import query
from lexmill.scale import numbered, table


def _docs(spark, d):
    return table(spark, d, "documents").filter("text IS NOT NULL")


_EN = ", ".join(f"'{w}'" for w in X.ENGLISH)


@query(f"""
    SELECT doc_id, CASE WHEN n > 0 THEN hits / n ELSE 0.0 END AS share, n < 30 OR hits >= 0.06 * n AS english
    FROM (SELECT doc_id, len(ws) AS n, len(list_filter(ws, lambda w: list_contains([{_EN}], w))) AS hits
          FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents WHERE text IS NOT NULL))
""")
def lang_by_stopwords(spark, d):
    """English by the share of stop words; short texts pass."""
    w = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    rows = _docs(spark, d).select("doc_id", w.alias("w"))
    return rows.select("doc_id", X.stop_share(F.col("w")).alias("share"), ((F.size("w") < 30) | (X.stop_share(F.col("w")) >= 0.06)).alias("english"))


def _argmax_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT doc_id, n, '{k}' AS l, len(list_filter(ws, lambda w: list_contains([{', '.join(repr(x) for x in v.split())}], w))) AS h FROM t" for k, v in X.STOP_WORDS.items())
    return f"""
    WITH t AS (SELECT doc_id, text, ws, len(ws) AS n FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '[\\p{{L}}]+') AS ws FROM documents WHERE text IS NOT NULL)),
    s AS ({parts}),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN l = 'en' AND h >= 0.2 * n THEN 0 ELSE 1 END, h DESC, l) AS k FROM s),
    c AS (SELECT doc_id, len(regexp_extract_all(text, '[\\p{{Cyrillic}}]')) AS cy, len(regexp_extract_all(text, '\\p{{L}}')) AS al FROM t)
    SELECT doc_id, CASE WHEN cy > 0.3 * al THEN 'ru' WHEN h >= 0.03 * n AND h > 0 THEN l ELSE 'und' END AS found FROM r JOIN c USING (doc_id) WHERE k = 1
    """


@query(_argmax_sql())
def lang_argmax(spark, d):
    """The language with the most stop words: English if it has its share, Cyrillic letters for Russian, else und."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))
    rows = _docs(spark, d).select("doc_id", w.alias("w"), F.regexp_count("text", F.lit(r"[\p{IsCyrillic}]")).alias("cy"), F.regexp_count("text", F.lit(r"\p{L}")).alias("al"))
    hits = [F.struct(X.hits_of(F.col("w"), v.split()).alias("h"), F.lit(k).alias("l")) for k, v in X.STOP_WORDS.items()]
    n = F.size("w")
    best = F.reduce(F.array(*hits), hits[0], lambda a, b: F.when((b["h"] > a["h"]) | ((b["h"] == a["h"]) & (b["l"] < a["l"])), b).otherwise(a))
    rows = rows.withColumn("best", best).withColumn("en", hits[list(X.STOP_WORDS).index("en")]["h"])
    l, h = F.when(F.col("en") >= 0.2 * n, "en").otherwise(F.col("best.l")), F.when(F.col("en") >= 0.2 * n, F.col("en")).otherwise(F.col("best.h"))
    return rows.select("doc_id", F.when(F.col("cy") > 0.3 * F.col("al"), "ru").when((h >= 0.03 * n) & (h > 0), l).otherwise("und").alias("found"))


@query("SELECT coalesce(lang, 'none') AS lang, count(*) AS docs, count(*) FILTER (WHERE lang = 'en') AS kept FROM documents GROUP BY 1")
def lang_filter_counts(spark, d):
    docs = table(spark, d, "documents")
    return docs.groupBy(F.coalesce("lang", F.lit("none")).alias("lang")).agg(F.count("*").alias("docs"), F.count_if(F.col("lang") == "en").alias("kept"))


@query("SELECT doc_id FROM documents WHERE substr(sha1(text), 1, 8) < '33333333'")
def sample_frac_hash(spark, d):
    """A fifth of the texts by their own hash: equal texts share their lot, whatever else is in the table."""
    return _docs(spark, d).filter(X.hash_below("text", 0.2)).select("doc_id")


@query("""
    SELECT key, shelf, substr(sha256('7:' || shelf || ':' || key), 1, 12) < '199999999999' AND words BETWEEN 60 AND 2000 AS heldout FROM works
""")
def heldout_split(spark, d):
    """Held-out choice by lot: a work's lot hangs on seed, shelf and key alone, so adding works moves none."""
    works = table(spark, d, "works")
    return works.select("key", "shelf", (X.lot(F.concat_ws(":", F.lit("7"), "shelf", "key"), 0.1) & F.col("words").between(60, 2000)).alias("heldout"))


@query("""
    WITH n AS (SELECT key, substr(sha256('7:' || shelf || ':' || key), 1, 12) < '199999999999' AS lot, split FROM works)
    SELECT key, CASE WHEN lot AND split IS DISTINCT FROM 'heldout' THEN 'new' WHEN NOT lot AND split = 'heldout' THEN 'gone' ELSE 'same' END AS change, coalesce(split = 'heldout', false) OR lot AS sticky FROM n
""")
def heldout_changes(spark, d):
    """The new choice against the standing one: sticky keeps old members whatever the lot says now."""
    n = table(spark, d, "works").select("key", X.lot(F.concat_ws(":", F.lit("7"), "shelf", "key"), 0.1).alias("lot"), "split")
    old = F.coalesce(F.col("split") == "heldout", F.lit(False))
    return n.select("key", F.when(F.col("lot") & ~old, "new").when(~F.col("lot") & old, "gone").otherwise("same").alias("change"), (old | F.col("lot")).alias("sticky"))


@query("""
    WITH p AS (SELECT path, trim(unnest(string_split(text, chr(10))), ' ') AS p FROM files WHERE text <> ''),
    q AS (SELECT path, p FROM p WHERE regexp_replace(p, '\\s', '', 'g') <> ''),
    w AS (SELECT path, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words FROM files WHERE text <> ''),
    s AS (SELECT path, avg(CASE WHEN regexp_matches(p, '^[a-z]') THEN 1.0 ELSE 0.0 END) AS lower_open, avg(CASE WHEN regexp_matches(p, '^[A-Z][A-Za-z ]{1,24}:') THEN 1.0 ELSE 0.0 END) AS script FROM q GROUP BY path)
    SELECT path, list_filter([CASE WHEN words < 150 THEN 'short' END, CASE WHEN lower_open > 0.35 THEN 'broken paragraphs' END, CASE WHEN script > 0.2 THEN 'script' END], lambda x: x IS NOT NULL) AS reasons
    FROM w JOIN s USING (path)
""")
def quality_reasons(spark, d):
    """Why a text is poor: too short, paragraphs that open in lower case, script lines."""
    f = table(spark, d, "files").filter("text <> ''").select("path", F.size(X.ws_words("text")).alias("words"), X.paragraphs("text").alias("p"))
    share = lambda pattern: F.size(F.filter("p", lambda x: x.rlike(pattern))) / F.size("p")
    f = f.filter(F.size("p") > 0)
    return f.select("path", F.array_compact(F.array(F.when(F.col("words") < 150, "short"), F.when(share("^[a-z]") > 0.35, "broken paragraphs"), F.when(share("^[A-Z][A-Za-z ]{1,24}:") > 0.2, "script"))).alias("reasons"))


#: Signs of the web in a text, the first that matches names it.
WEB_FLAGS = (
    ("url", r"(?i)https?://|\bwww\.[a-z0-9-]+\.|\b[a-z0-9-]+\.(?:com|net|org|edu|gov|io|co\.uk)\b"),
    ("html", r"(?i)</?(?:a|p|br|div|span|img|h[1-6]|ul|ol|li|table|tr|td|script|style|strong|em|blockquote)\b[^>]{0,200}>"),
    ("markdown header", r"(?m)^[ \t]{0,3}#{1,6}[ \t]+\S"),
    ("markdown link", r"\[[^\]\n]{1,80}\]\([^)\n]{1,200}\)"),
    ("byline", r"(?i)\b(?:photo|photos|photograph|image|illustration|written|posted|submitted|published|reviewed|edited|translated)\s+by\b"),
    ("blog chrome", r"(?i)\b(?:leave a comment|no comments|\d+\s+comments?|post a comment|subscribe|share this|click here|read more|continue reading|author'?s note|filed under|related posts?|permalink|trackback|reply to this)\b"),
    ("chapter", r"(?im)^[ \t]*chapter\s+\d"),
    ("copyright", r"(?i)©|\(c\)\s*(?:19|20)\d{2}|all rights reserved|creative commons|unless otherwise stated, the content of this page"),
    ("bracket tag", r"(?i)\[(?:wip|oc|edit|deleted|removed|spoilers?|nsfw|tw|cw|citation needed|author'?s note|update)\b[^\]\n]{0,30}\]"),
    ("handle", r"(?:^|[\s(])@[A-Za-z0-9_]{2,30}\b"),
    ("hashtag", r"(?:^|[\s(])#[A-Za-z][A-Za-z0-9_]{1,30}\b"),
)


@query("SELECT path, CASE " + " ".join("WHEN regexp_matches(text, '" + p.replace("'", "''") + f"') THEN '{n}'" for n, p in WEB_FLAGS) + " END AS flag FROM files WHERE text IS NOT NULL")
def web_flag(spark, d):
    flag = F.lit(None).cast("string")
    for name, p in reversed(WEB_FLAGS):
        flag = F.when(F.col("text").rlike(p), name).otherwise(flag)
    return table(spark, d, "files").filter("text IS NOT NULL").select("path", flag.alias("flag"))


_GRAM = "list_transform(range(1, greatest(len(t) - {0} + 2, 1)), lambda i: array_to_string(t[i:i + {0} - 1], ' '))"


@query(f"""
    WITH a AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]') AS t FROM documents WHERE text IS NOT NULL),
    g AS (SELECT doc_id, len(t) AS n, {_GRAM.format(2)} AS b, {_GRAM.format(4)} AS q FROM a)
    SELECT doc_id, n, CASE WHEN len(b) > 0 THEN len(list_distinct(b)) / len(b) ELSE 1.0 END AS distinct_2, CASE WHEN len(q) > 0 THEN 1 - len(list_distinct(q)) / len(q) ELSE 0.0 END AS rep_4 FROM g
""")
def distinct2_rep4(spark, d):
    """Diversity of pairs and repetition of fours, by words and signs."""
    a = _docs(spark, d).select("doc_id", X.punct_tokens("text").alias("t"))
    g = a.select("doc_id", F.size("t").alias("n"), X.hashed_runs(F.col("t"), 2).alias("b"), X.hashed_runs(F.col("t"), 4).alias("q"))
    return g.select("doc_id", "n", X.distinct_share(F.col("b")).alias("distinct_2"), (1 - X.distinct_share(F.col("q"))).alias("rep_4"))


@query("""
    SELECT source, sum(len(regexp_extract_all(text, 'https?://'))) AS urls, sum(len(regexp_extract_all(text, '\\.(?:jpg|png|gif)'))) AS images, sum(len(regexp_extract_all(text, '©|[Cc]opyright'))) AS copyright,
      sum(len(regexp_extract_all(text, '(?:page|Page) [0-9]+'))) AS pages, sum(len(regexp_extract_all(text, '<[a-z/][^>]*>'))) AS tags FROM files WHERE text IS NOT NULL GROUP BY source
""")
def dirt_counts(spark, d):
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p))).cast("long")
    return table(spark, d, "files").filter("text IS NOT NULL").groupBy("source").agg(
        n("https?://").alias("urls"), n(r"\.(?:jpg|png|gif)").alias("images"), n("©|[Cc]opyright").alias("copyright"), n("(?:page|Page) [0-9]+").alias("pages"), n("<[a-z/][^>]*>").alias("tags")
    )


@query("""
    SELECT f.path, s.rough OR regexp_matches(f.text, '(?i)scanned by|ocr|page [0-9]+ of') AS rough FROM files f JOIN sources s ON s.name = f.source WHERE f.text IS NOT NULL
""")
def rough_copies(spark, d):
    """Copies marked as rough by their source or by marks of a scanner."""
    s = table(spark, d, "sources").select(F.col("name").alias("source"), "rough")
    f = table(spark, d, "files").filter("text IS NOT NULL")
    return f.join(F.broadcast(s), "source").select("path", (F.col("rough") | F.col("text").rlike("(?i)scanned by|ocr|page [0-9]+ of")).alias("rough"))  # sources: 26 rows


@query("""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL),
    m AS (SELECT doc_id, len(ws) AS words, len(list_filter(ws, lambda x: regexp_matches(x, '[\\p{Cyrillic}]') AND regexp_matches(x, '[A-Za-z]'))) AS mixed FROM w)
    SELECT doc_id, words, mixed FROM m WHERE mixed > 0
""")
def mixed_script_words(spark, d):
    w = _docs(spark, d).select("doc_id", X.ws_words("text").alias("w"))
    mixed = F.size(F.filter("w", lambda x: x.rlike(r"[\p{IsCyrillic}]") & x.rlike("[A-Za-z]")))
    return w.select("doc_id", F.size("w").alias("words"), mixed.alias("mixed")).filter("mixed > 0")


@query("""
    WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda x: trim(x, ' ')), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL),
    k AS (SELECT doc_id, s, list_filter(s, lambda x: NOT regexp_matches(x, '[\\p{Cyrillic}][A-Za-z]|[A-Za-z][\\p{Cyrillic}]')) AS kept FROM s)
    SELECT doc_id, array_to_string(kept, ' ') AS text, len(s) - len(kept) AS dropped FROM k WHERE len(kept) < len(s)
""")
def despam(spark, d):
    """Texts without the sentences that hold a word of mixed scripts."""
    s = _docs(spark, d).select("doc_id", X.sentences("text").alias("s"))
    kept = F.filter("s", lambda x: ~x.rlike(r"[\p{IsCyrillic}][A-Za-z]|[A-Za-z][\p{IsCyrillic}]"))
    return s.select("doc_id", "s", kept.alias("kept")).filter("size(kept) < size(s)").select("doc_id", F.array_join("kept", " ").alias("text"), (F.size("s") - F.size("kept")).alias("dropped"))


#: Rules of an override file: number, field, pattern, kind. Later rules win.
RULES = ((1, "path", "text/knotbook/%", "serial"), (2, "title", "(?i)bell", "bells"), (3, "source", "tollhouse", "road"), (4, "path", "%/The-%", "the"), (5, "title", "^Nothing like this$", "none"))
_rules_sql = "(VALUES " + ", ".join(str(r) for r in RULES) + ") r(number, field, pattern, kind)"


def _titled(spark, d):
    return table(spark, d, "files").select("path", "source", F.regexp_replace(F.regexp_extract("path", "([^/]+)--[0-9a-f]+[.]txt$", 1), "-", " ").alias("title"))


def _matches(spark, d):
    rules = spark.createDataFrame(RULES, "number int, field string, pattern string, kind string")
    on = F.expr("(field = 'path' AND path LIKE pattern) OR (field = 'title' AND title RLIKE pattern) OR (field = 'source' AND source = pattern)")
    return _titled(spark, d).join(F.broadcast(rules), on), rules  # the rules are a handful of constants


_RULE_JOIN = f"""f JOIN {_rules_sql} ON (field = 'path' AND path LIKE pattern) OR (field = 'title' AND regexp_matches(title, pattern)) OR (field = 'source' AND source = pattern)"""
_TITLED = "(SELECT path, source, replace(regexp_extract(path, '([^/]+)--[0-9a-f]+[.]txt$', 1), '-', ' ') AS title FROM files)"


@query(f"SELECT path, arg_max(kind, number) AS kind, max(number) AS rule FROM {_TITLED} {_RULE_JOIN} GROUP BY path")
def override_rules(spark, d):
    """The kind that the last matching rule gives each file."""
    return _matches(spark, d)[0].groupBy("path").agg(F.max_by("kind", "number").alias("kind"), F.max("number").alias("rule"))


@query(f"SELECT number, kind FROM {_rules_sql} WHERE number NOT IN (SELECT number FROM {_TITLED} {_RULE_JOIN})")
def unused_rules(spark, d):
    hits, rules = _matches(spark, d)
    return rules.join(hits.select("number").distinct(), "number", "left_anti").select("number", "kind")


@query("""
    WITH p AS (SELECT path, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM files WHERE text IS NOT NULL),
    w AS (SELECT path, n, trim(line) AS line, list_filter(regexp_split_to_array(trim(line), '\\s+'), lambda x: x <> '') AS ws FROM p)
    SELECT path, CAST(n AS INTEGER) AS line_no, line FROM w WHERE len(ws) BETWEEN 1 AND 12 AND NOT regexp_matches(line, '[.!?,;:]\\z') AND len(list_filter(ws, lambda x: length(x) > 3)) > 0
      AND len(list_filter(ws, lambda x: length(x) > 3 AND regexp_matches(x, '^[A-Z]'))) >= 0.6 * len(list_filter(ws, lambda x: length(x) > 3)) AND NOT regexp_matches(line, '^[IVXLC0-9. ]+\\z')
""")
def heading_lines(spark, d):
    """Lines shaped like headings: few words, no end mark, most longer words capitalised, no bare numerals."""
    lines = table(spark, d, "files").filter("text IS NOT NULL").select("path", F.posexplode(F.split("text", "\n")).alias("n", "line")).withColumn("line", F.trim("line"))
    w = lines.withColumn("w", X.ws_words("line")).withColumn("long", F.filter("w", lambda x: F.length(x) > 3))
    shaped = F.size("w").between(1, 12) & ~F.col("line").rlike(r"[.!?,;:]\z") & (F.size("long") > 0) & (F.size(F.filter("long", lambda x: x.rlike("^[A-Z]"))) >= 0.6 * F.size("long")) & ~F.col("line").rlike(r"^[IVXLC0-9. ]+\z")
    return w.filter(shaped).select("path", (F.col("n") + 1).alias("line_no"), "line")


@query("""
    SELECT path FROM files WHERE text IS NOT NULL AND length(text) >= 2000 AND len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) >= 120
""")
def min_counts(spark, d):
    return table(spark, d, "files").filter(F.col("text").isNotNull() & (F.length("text") >= 2000) & (F.size(X.ws_words("text")) >= 120)).select("path")


#: Patterns of the rates, matched in lower case. Word borders are blanks: engines differ on what else ends a word.
RATES = {
    "meta_rate": r"(?:novel|fiction|writer|author|editor|publish|reader|genre|story collection)", "biblio_rate": r"(?:1[89][0-9]{2}|20[0-2][0-9]|edited by|award|prize)",
    "narrative_rate": r" (?:said|he|she|was|had|were|his|her)[ ,.;!?]", "address_rate": r"(?:this issue|our readers|subscribe|this episode)",
}


@query(f"""
    WITH t AS (SELECT doc_id, lower(text) AS l, text, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: regexp_replace(x, '\\s', '', 'g') <> '') AS p FROM t)
    SELECT doc_id, words, {", ".join(f"CASE WHEN words > 0 THEN len(regexp_extract_all(l, '{p}')) * 1000.0 / words ELSE 0.0 END AS {n}" for n, p in RATES.items())},
      len(p) AS paragraphs, len(list_filter(p, lambda x: regexp_matches(x, '^["“«]'))) AS speech_open, len(list_filter(p, lambda x: length(x) <= 60 AND NOT regexp_matches(x, '[.!?]\\z'))) AS short_open, len(list_filter(p, lambda x: regexp_matches(x, '^[A-Z][A-Za-z ]+:'))) AS labels
    FROM t JOIN p USING (doc_id)
""")
def rate_features(spark, d):
    """Rates in a thousand words and the shapes of paragraphs: the features of the kind classifier."""
    t = _docs(spark, d).select("doc_id", F.lower("text").alias("l"), F.size(X.ws_words("text")).alias("words"), X.paragraphs("text").alias("p"))
    count = lambda f: F.size(F.filter("p", f))
    return t.select(
        "doc_id", "words", *[X.rate("l", p, F.col("words")).alias(n) for n, p in RATES.items()], F.size("p").alias("paragraphs"), count(lambda x: x.rlike('^["“«]')).alias("speech_open"),
        count(lambda x: (F.length(x) <= 60) & ~x.rlike(r"[.!?]\z")).alias("short_open"), count(lambda x: x.rlike("^[A-Z][A-Za-z ]+:")).alias("labels"),
    )


_FEATURES = rate_features


@query("""
    WITH f AS (
      SELECT doc_id, words, paragraphs, speech_open / greatest(paragraphs, 1) AS speech, short_open / greatest(paragraphs, 1) AS short, labels / greatest(paragraphs, 1) AS label_share, labels, meta_rate, biblio_rate, narrative_rate, address_rate FROM rates),
    e AS (SELECT doc_id, words, short, paragraphs,
      list_filter([CASE WHEN label_share >= 0.2 AND labels >= 6 THEN {'signal': 'qa', 'weight': 2.0} END, CASE WHEN words >= 120 AND meta_rate >= 22 THEN {'signal': 'meta_high', 'weight': 3.0} WHEN words >= 120 AND meta_rate >= 10 THEN {'signal': 'meta_mid', 'weight': 1.5} END,
        CASE WHEN words >= 120 AND biblio_rate >= 14 THEN {'signal': 'biblio_high', 'weight': 1.5} END, CASE WHEN words >= 120 AND address_rate >= 5 THEN {'signal': 'address', 'weight': 1.5} END, CASE WHEN words >= 120 AND narrative_rate < 30 THEN {'signal': 'narrative_low', 'weight': 1.5} END,
        CASE WHEN words >= 120 AND narrative_rate >= 60 THEN {'signal': 'narrative_high', 'weight': -1.5} END, CASE WHEN speech >= 0.15 THEN {'signal': 'speech', 'weight': -1.5} END, CASE WHEN words >= 120 AND meta_rate < 3 THEN {'signal': 'meta_low', 'weight': -1.5} END, CASE WHEN words >= 6000 THEN {'signal': 'long', 'weight': -0.5} END], lambda x: x IS NOT NULL) AS evidence FROM f),
    s AS (SELECT *, coalesce(list_sum(list_transform(evidence, lambda x: x.weight)), 0.0) AS net FROM e)
    SELECT doc_id, CASE WHEN words < 60 THEN 'stub' WHEN paragraphs >= 6 AND short >= 0.55 THEN 'verse' WHEN net >= 3.5 THEN 'nonfiction' WHEN net >= 1.5 THEN 'unsure' ELSE 'fiction' END AS kind, net, list_transform(evidence, lambda x: x.signal) AS signals FROM s
""".replace("FROM rates", "FROM (" + """
    SELECT * FROM (WITH t AS (SELECT doc_id, lower(text) AS l, text, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: regexp_replace(x, '\\s', '', 'g') <> '') AS p FROM t)
    SELECT doc_id, words, """ + ", ".join(f"CASE WHEN words > 0 THEN len(regexp_extract_all(l, '{p}')) * 1000.0 / words ELSE 0.0 END AS {n}" for n, p in RATES.items()) + """,
      len(p) AS paragraphs, len(list_filter(p, lambda x: regexp_matches(x, '^["“«]'))) AS speech_open, len(list_filter(p, lambda x: length(x) <= 60 AND NOT regexp_matches(x, '[.!?]\\z'))) AS short_open, len(list_filter(p, lambda x: regexp_matches(x, '^[A-Z][A-Za-z ]+:'))) AS labels
    FROM t JOIN p USING (doc_id)))"""))
def kind_classifier(spark, d):
    """Ordered hard rules, then weighted evidence: what speaks for an article less what speaks for a story."""
    f = _FEATURES(spark, d)
    share = lambda c: F.col(c) / F.greatest("paragraphs", F.lit(1))
    long = F.col("words") >= 120
    signal = lambda name, weight: F.struct(F.lit(name).alias("signal"), F.lit(weight).alias("weight"))
    evidence = F.array_compact(F.array(
        F.when((share("labels") >= 0.2) & (F.col("labels") >= 6), signal("qa", 2.0)),
        F.when(long & (F.col("meta_rate") >= 22), signal("meta_high", 3.0)).when(long & (F.col("meta_rate") >= 10), signal("meta_mid", 1.5)),
        F.when(long & (F.col("biblio_rate") >= 14), signal("biblio_high", 1.5)), F.when(long & (F.col("address_rate") >= 5), signal("address", 1.5)), F.when(long & (F.col("narrative_rate") < 30), signal("narrative_low", 1.5)),
        F.when(long & (F.col("narrative_rate") >= 60), signal("narrative_high", -1.5)), F.when(share("speech_open") >= 0.15, signal("speech", -1.5)), F.when(long & (F.col("meta_rate") < 3), signal("meta_low", -1.5)), F.when(F.col("words") >= 6000, signal("long", -0.5)),
    ))
    net = F.aggregate("evidence", F.lit(0.0), lambda a, x: a + x["weight"])
    kind = F.when(F.col("words") < 60, "stub").when((F.col("paragraphs") >= 6) & (share("short_open") >= 0.55), "verse").when(F.col("net") >= 3.5, "nonfiction").when(F.col("net") >= 1.5, "unsure").otherwise("fiction")
    return f.withColumn("evidence", evidence).withColumn("net", net).select("doc_id", kind.alias("kind"), "net", F.transform("evidence", lambda x: x["signal"]).alias("signals"))


@query("""
    WITH p AS (SELECT path, length(trim(unnest(string_split(text, chr(10))), ' ')) AS n FROM files WHERE text <> ''),
    s AS (SELECT path, list(n ORDER BY n) AS a, sum(n) AS total, sum(CASE WHEN n > 400 THEN n ELSE 0 END) AS big FROM p WHERE n > 0 GROUP BY path)
    SELECT path, len(a) AS paragraphs, a[CAST(floor(len(a) / 2.0) AS INTEGER) + 1] AS p50, a[CAST(floor(len(a) * 0.9) AS INTEGER) + 1] AS p90, big > 0.5 * total AS glued FROM s
""")
def chunk_health(spark, d):
    """Percentiles of paragraph lengths by index, without interpolation, and whether most of the text stands in overlong ones."""
    a = F.filter(F.transform(F.split("text", "\n"), lambda x: F.length(F.trim(x))), lambda n: n > 0)
    f = table(spark, d, "files").filter("text <> ''").select("path", F.array_sort(a).alias("a")).filter("size(a) > 0")
    at = lambda q: F.element_at("a", (F.floor(F.size("a") * q) + 1).cast("int"))
    add = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    return f.select("path", F.size("a").alias("paragraphs"), at(0.5).alias("p50"), at(0.9).alias("p90"), (add(F.filter("a", lambda n: n > 400)) > 0.5 * add(F.col("a"))).alias("glued"))


@query("""
    WITH e AS (SELECT CASE WHEN lang IS DISTINCT FROM 'en' THEN 'not en' WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN length(text) < 300 THEN 'short' WHEN NOT substr(sha1(text), 1, 8) < '80000000' THEN 'not sampled'
      WHEN regexp_matches(text, 'https?://') THEN 'web' ELSE 'emitted' END AS exit_reason FROM documents)
    SELECT exit_reason, count(*) AS docs FROM e GROUP BY 1
""")
def exit_reasons(spark, d):
    """One pass of ordered filters, the cheap ones first, with a counter for each exit."""
    t = F.col("text")
    e = F.when(~F.col("lang").eqNullSafe("en"), "not en").when(t.isNull() | (F.trim(t) == ""), "empty").when(F.length(t) < 300, "short").when(~X.hash_below(t, 0.5), "not sampled").when(t.rlike("https?://"), "web").otherwise("emitted")
    return table(spark, d, "documents").groupBy(e.alias("exit_reason")).agg(F.count("*").alias("docs"))


@query("""
    WITH a AS (SELECT source, lower(author) AS author, count(*) AS n, count(*) FILTER (WHERE genre IN ('interview', 'review', 'essay')) AS strong FROM documents WHERE author IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2)
    SELECT * FROM a WHERE strong >= 1 AND strong >= 0.5 * n
""")
def columnists(spark, d):
    """Authors most of whose pieces in a source are articles."""
    a = table(spark, d, "documents").filter("author IS NOT NULL AND source IS NOT NULL").groupBy("source", F.lower("author").alias("author"))
    return a.agg(F.count("*").alias("n"), F.count_if(F.col("genre").isin("interview", "review", "essay")).alias("strong")).filter("strong >= 1 AND strong >= 0.5 * n")


@query("""
    WITH p AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS p FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, p AS head, count(*) AS n FROM p WHERE p <> '' AND len(list_filter(regexp_split_to_array(p, '\\s+'), lambda x: x <> '')) <= 8 GROUP BY 1, 2 HAVING count(*) >= 2
""")
def running_heads(spark, d):
    """Short paragraphs that come again and again within one document."""
    p = _docs(spark, d).select("doc_id", F.explode(F.split("text", "\n")).alias("head")).withColumn("head", F.trim("head")).filter(F.col("head") != "")
    return p.filter(F.size(X.ws_words("head")) <= 8).groupBy("doc_id", "head").agg(F.count("*").alias("n")).filter("n >= 2")


@query("SELECT md5(text) AS h, count(*) AS n FROM documents WHERE text <> '' GROUP BY text HAVING count(*) >= 2")
def shared_pages(spark, d):
    return _docs(spark, d).filter("text <> ''").groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("n")).filter("n >= 2")


@query("""
    WITH w AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM documents WHERE text IS NOT NULL)
    SELECT lower(w) AS word, count(*) FILTER (WHERE regexp_matches(w, '^[A-Z]')) AS capital, count(*) FILTER (WHERE NOT regexp_matches(w, '^[A-Z]')) AS small FROM w GROUP BY 1
""")
def case_counts(spark, d):
    """How often each word stands with a capital: the table for re-casing small caps."""
    w = _docs(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    return w.groupBy(F.lower("w").alias("word")).agg(F.count_if(F.col("w").rlike("^[A-Z]")).alias("capital"), F.count_if(~F.col("w").rlike("^[A-Z]")).alias("small"))


@query("""
    WITH n AS (SELECT source, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents WHERE text IS NOT NULL),
    b AS (SELECT source, CASE WHEN n < 30 THEN '<30' WHEN n < 100 THEN '30-100' WHEN n < 300 THEN '100-300' ELSE '>=300' END AS bin FROM n)
    SELECT coalesce(source, 'none') AS source, bin, count(*) AS docs FROM b GROUP BY 1, 2 UNION ALL SELECT 'all', bin, count(*) FROM b GROUP BY bin
""")
def length_bins(spark, d):
    """Length bins of each source, with a row of totals from grouping sets."""
    n = F.size(X.ws_words("text"))
    b = _docs(spark, d).select(F.coalesce("source", F.lit("none")).alias("source"), F.when(n < 30, "<30").when(n < 100, "30-100").when(n < 300, "100-300").otherwise(">=300").alias("bin"))
    g = b.groupingSets([[F.col("source"), F.col("bin")], [F.col("bin")]], F.col("source"), F.col("bin")).agg(F.count("*").alias("docs"), F.grouping("source").alias("g"))
    return g.select(F.when(F.col("g") == 1, "all").otherwise(F.col("source")).alias("source"), "bin", "docs")


@query("""
    WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM documents WHERE title IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY doc_id) AS k FROM s)
    SELECT doc_id, CASE WHEN k = 1 THEN slug ELSE slug || '-' || k END AS slug FROM r
""")
def slug_numbering(spark, d):
    s = table(spark, d, "documents").filter("title IS NOT NULL").select("doc_id", X.slug("title").alias("slug"))
    k = F.row_number().over(W.partitionBy("slug").orderBy("doc_id"))
    return s.withColumn("k", k).select("doc_id", F.when(F.col("k") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", F.col("k").cast("string"))).alias("slug"))


@query("""
    WITH t AS (SELECT doc_id, regexp_replace(lower(title), '\\([^)]*\\)|\\[[^\\]]*\\]', ' ', 'g') AS t FROM documents WHERE title IS NOT NULL),
    u AS (SELECT doc_id, regexp_replace(t, '^\\s*(?:episode|no\\.|nr\\.|#)?\\s*[0-9]+\\s*[:.-]\\s*', '') AS t FROM t)
    SELECT doc_id, trim(regexp_replace(regexp_replace(t, '^\\s*(?:the|a|an)\\s+', ''), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS title_key FROM u
""")
def title_normalise(spark, d):
    return table(spark, d, "documents").filter("title IS NOT NULL").select("doc_id", X.title_key("title").alias("title_key"))


@query("""
    WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda x: trim(x, ' ')), lambda x: x <> '') AS s FROM documents WHERE text <> '')
    SELECT doc_id, array_to_string(s[greatest(len(s) - 2, 1):], ' ') AS ribbon FROM s
""")
def last_sentences(spark, d):
    """The last three sentences."""
    s = _docs(spark, d).filter("text <> ''").select("doc_id", X.sentences("text").alias("s"))
    return s.select("doc_id", F.array_join(F.slice("s", F.greatest(F.size("s") - 2, F.lit(1)), 3), " ").alias("ribbon"))


@query("""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, array_to_string(w[greatest(len(w) - 24, 1):], ' ') AS tail FROM w
""")
def tail_of_words(spark, d):
    return _docs(spark, d).select("doc_id", X.tail_words("text", 25).alias("tail"))


@query("""
    SELECT doc_id, trim(regexp_replace(regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g'), '\\s+', ' ', 'g')) AS plain,
      regexp_replace(array_to_string(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')[1:2], ' '), '[0-9]', '0', 'g') AS prefix FROM documents WHERE text IS NOT NULL
""")
def normalised_text(spark, d):
    return _docs(spark, d).select("doc_id", X.squashed("text").alias("plain"), X.prefix_key("text").alias("prefix"))


@query("""
    WITH s AS (SELECT doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY sha256('3:' || doc_id), doc_id) AS k FROM documents)
    SELECT doc_id FROM s WHERE k <= 5
""")
def stratified_sample(spark, d):
    """Five documents of each source and language, by a seeded hash: the limit is the feature."""
    k = F.row_number().over(W.partitionBy("source", "lang").orderBy(F.sha2(F.concat_ws(":", F.lit("3"), F.col("doc_id").cast("string")), 256), "doc_id"))
    return table(spark, d, "documents").select("doc_id", "source", "lang").withColumn("k", k).filter("k <= 5").select("doc_id")


@query("""
    WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) SELECT doc_id, source FROM r WHERE k % 10 = 0
""")
def systematic_sample(spark, d):
    """Every tenth document of a source."""
    return numbered(table(spark, d, "documents").select("doc_id", "source"), ["source"], ["doc_id"]).filter("k % 10 = 0").select("doc_id", "source")


@query("""
    WITH t AS (SELECT key, regexp_replace(lower(regexp_extract(text, '(?i)\\b(one|two|three|four|five|six|seven|eight|nine|ten) ', 1)), '^$', 'none') AS word, regexp_extract(text, '\\b(1[0-9]{3}|20[0-9]{2})\\b', 1) AS year FROM works WHERE text IS NOT NULL)
    SELECT key, list_position(['one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten'], word) AS number, CASE WHEN year = '' THEN NULL ELSE CAST(year AS INTEGER) END AS year FROM t
""")
def number_words(spark, d):
    """The first number word as a number, and the first year."""
    names = "one two three four five six seven eight nine ten".split()
    t = table(spark, d, "works").filter("text IS NOT NULL")
    word = F.lower(F.regexp_extract("text", r"(?i)\b(one|two|three|four|five|six|seven|eight|nine|ten) ", 1))
    year = F.regexp_extract("text", r"\b(1[0-9]{3}|20[0-9]{2})\b", 1)
    return t.select("key", F.nullif(F.array_position(X._array(names), word), F.lit(0)).alias("number"), F.when(year != "", year.cast("int")).alias("year"))


@query("""
    SELECT lang, avg(n_chars) AS mean, stddev_pop(n_chars) AS sd, count(n_chars) AS n, median(n_chars) AS mid FROM documents GROUP BY lang
""")
def stddev_metrics(spark, d):
    """Mean, population deviation and median without nulls."""
    return table(spark, d, "documents").groupBy("lang").agg(F.avg("n_chars").alias("mean"), F.stddev_pop("n_chars").alias("sd"), F.count("n_chars").alias("n"), F.median("n_chars").alias("mid"))


@query("""
    WITH g AS (SELECT genre, source, lang, count(*) AS n, sum(n_chars) AS chars, list(n_chars) AS lens FROM documents GROUP BY ALL)
    SELECT genre, sum(n) AS docs, sum(chars) AS chars, (SELECT count(*) - count(DISTINCT n_chars) FROM documents x WHERE x.genre IS NOT DISTINCT FROM g.genre AND x.n_chars IS NOT NULL) AS duplicate_looking FROM g GROUP BY genre
""")
def category_survey(spark, d):
    """Counts per genre in one pass of partial and final aggregation; equal lengths within a genre look like duplicates."""
    g = table(spark, d, "documents").groupBy("genre", "n_chars").agg(F.count("*").alias("n"))
    return g.groupBy("genre").agg(F.sum("n").alias("docs"), F.sum(F.col("n_chars") * F.col("n")).alias("chars"), F.sum(F.when(F.col("n_chars").isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicate_looking"))
