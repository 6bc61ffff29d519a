"""Further operators of the cleaners and small consumers: routing, look-ups by metadata, assembly, trees, audits."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions import tokens
from lexmill.operators import near, tree
from lexmill.plans.catalog import query
from lexmill.scale import small, stored, table


def _docs(spark, d):
    return table(spark, d, "documents").filter("text IS NOT NULL")


@query("""
    SELECT doc_id, CASE WHEN regexp_matches(lower(coalesce(genre, '') || ' ' || coalesce(title, '')), 'review|interview|essay|letter') THEN 2 WHEN regexp_matches(lower(coalesce(genre, '')), 'story|chapter|poem') AND NOT regexp_matches(lower(coalesce(title, '')), 'notes|index') THEN 1 END AS shelf FROM documents
""")
def shelf_routing(spark, d):
    """Routing by include and exclude patterns over genre and title."""
    g, t = F.lower(F.coalesce("genre", F.lit(""))), F.lower(F.coalesce("title", F.lit("")))
    shelf = F.when(F.concat_ws(" ", g, t).rlike("review|interview|essay|letter"), 2).when(g.rlike("story|chapter|poem") & ~t.rlike("notes|index"), 1)
    return table(spark, d, "documents").select("doc_id", shelf.alias("shelf"))


@query("""
    SELECT doc_id, regexp_matches(lower(text), '(?s)(?:dagger|sword).{0,200}(?:night|dawn)|(?:night|dawn).{0,200}(?:dagger|sword)') AS near, len(regexp_extract_all(lower(text), 'dagger|sword')) AS strong FROM documents WHERE text IS NOT NULL AND regexp_matches(lower(text), 'dagger|sword')
""")
def proximity_flags(spark, d):
    """Texts with a strong term, and whether one of a second list stands within 200 characters of it: the cheap test first."""
    t = F.lower("text")
    return _docs(spark, d).filter(t.rlike("dagger|sword")).select("doc_id", t.rlike("(?s)(?:dagger|sword).{0,200}(?:night|dawn)|(?:night|dawn).{0,200}(?:dagger|sword)").alias("near"), F.regexp_count(t, F.lit("dagger|sword")).alias("strong"))


@query("""
    SELECT path, CASE lower(regexp_extract(text, '(?i)(?:rated|reading time|chapter|issue|episode|book) ([a-z0-9]+)', 1)) WHEN '' THEN NULL WHEN 'one' THEN '1' WHEN 'two' THEN '2' ELSE lower(regexp_extract(text, '(?i)(?:rated|reading time|chapter|issue|episode|book) ([a-z0-9]+)', 1)) END AS label FROM files WHERE text IS NOT NULL
""")
def label_extract(spark, d):
    """The first label of a text, synonyms folded."""
    x = F.lower(F.regexp_extract("text", "(?i)(?:rated|reading time|chapter|issue|episode|book) ([a-z0-9]+)", 1))
    return table(spark, d, "files").filter("text IS NOT NULL").select("path", F.when(x == "", None).when(x == "one", "1").when(x == "two", "2").otherwise(x).alias("label"))


_SETS = """
    w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL), g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS e FROM w, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(e, '|' ORDER BY e)) AS h FROM g GROUP BY doc_id), c AS (SELECT h, min(doc_id) AS class FROM n GROUP BY h), r AS (SELECT g.doc_id, e, n FROM g JOIN n USING (doc_id) JOIN c ON c.class = g.doc_id)
"""


@query(f"""
    WITH {_SETS}, p AS (SELECT a.doc_id AS small, b.doc_id AS large, count(*) AS s, a.n FROM r a JOIN r b ON a.e = b.e AND a.doc_id <> b.doc_id AND (a.n < b.n OR (a.n = b.n AND a.doc_id < b.doc_id)) GROUP BY ALL) SELECT small, large, s / n AS share FROM p WHERE s >= 0.8 * n
""")
def pair_containment(spark, d):
    """Texts of which at least four fifths, in runs of five words, stand in a text that is no shorter."""
    texts = near.squeezed(table(spark, d, "documents"), "doc_id")
    marked = stored(near.digests(texts))
    return near.contained_pairs(texts.join(small(stored(near.copies(marked))), "key", "left_anti"), sizes=marked)


_HEADS = "SELECT path, n, line FROM (SELECT path, generate_subscripts(ls, 1) AS n, unnest(ls) AS line FROM (SELECT path, string_split(text, chr(10)) AS ls FROM files WHERE text IS NOT NULL)) WHERE regexp_matches(line, '^[A-Z][^.!?]{4,60}\\z')"


def _common_headings(spark, d):
    """a < b and the lines x and y at which a heading of both stands first."""
    l = table(spark, d, "files").filter("text IS NOT NULL").select("path", F.posexplode(F.split("text", "\n")).alias("n", "line")).filter(F.col("line").rlike(r"^[A-Z][^.!?]{4,60}\z"))
    h = l.groupBy("path", "line").agg(F.min("n").alias("n"))
    m = stored(h.join(h.groupBy("line").agg(F.count("*").alias("c")).filter("c BETWEEN 2 AND 12").select("line"), "line"))
    return m.alias("x").join(m.alias("y"), F.expr("x.line = y.line AND x.path < y.path")).select(F.col("x.path").alias("a"), F.col("y.path").alias("b"), F.col("x.n").alias("x"), F.col("y.n").alias("y"))


@query(f"""
    WITH h AS (SELECT path, min(n) AS n, line FROM ({_HEADS.replace(chr(92) + 'z', chr(92) + 'z')}) GROUP BY path, line), k AS (SELECT line FROM h GROUP BY line HAVING count(*) BETWEEN 2 AND 12), m AS (SELECT h.* FROM h JOIN k USING (line))
    SELECT a.path AS a, b.path AS b, count(*) AS shared FROM m a JOIN m b ON a.line = b.line AND a.path < b.path GROUP BY 1, 2 HAVING count(*) >= 2 AND max(a.n) - min(a.n) <= 30 AND max(b.n) - min(b.n) <= 30
""")
def shared_headings(spark, d):
    """Files with two common headings, all of them close together in both; a heading in more than twelve files is common by definition."""
    p = _common_headings(spark, d).groupBy("a", "b")
    return p.agg(F.count("*").alias("shared"), (F.max("x") - F.min("x")).alias("u"), (F.max("y") - F.min("y")).alias("v")).filter("shared >= 2 AND u <= 30 AND v <= 30").select("a", "b", "shared")


@query()
def near_headings(spark, d):
    """The same if any two of the common headings are close together in both, however far away others are."""
    # a line is one heading, so at most thirty stand in the window
    before = F.collect_list("y").over(W.partitionBy("a", "b").orderBy("x").rangeBetween(-30, -1))
    p = _common_headings(spark, d).withColumn("before", before).withColumn("near", F.exists("before", lambda other: F.abs(other - F.col("y")) <= 30))
    return p.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("near").alias("near")).filter("near").select("a", "b", "shared")


@query("""
    WITH p AS (SELECT DISTINCT least(a.path, b.path) AS x, greatest(a.path, b.path) AS y FROM pairs WHERE a.path <> b.path), f AS (SELECT path, list_distinct(list_filter(hashes, lambda h: h <> 0)) AS u FROM files JOIN docs ON docs.num = files.doc)
    SELECT x, y, len(list_intersect(f.u, g.u)) AS shared, len(f.u) AS of_x, len(g.u) AS of_y FROM p JOIN f ON f.path = x JOIN f g ON g.path = y
""")
def pair_residue(spark, d):
    """For every matched pair of files, the units that both hold."""
    p = table(spark, d, "pairs").filter("a.path <> b.path").select(F.least("a.path", "b.path").alias("x"), F.greatest("a.path", "b.path").alias("y")).distinct()
    f = table(spark, d, "files").join(table(spark, d, "docs"), F.col("doc") == F.col("num")).select("path", F.array_distinct(F.filter("hashes", lambda h: h != 0)).alias("u"))
    j = p.join(f.select(F.col("path").alias("x"), F.col("u").alias("ux")), "x").join(f.select(F.col("path").alias("y"), F.col("u").alias("uy")), "y")
    return j.select("x", "y", F.size(F.array_intersect("ux", "uy")).alias("shared"), F.size("ux").alias("of_x"), F.size("uy").alias("of_y"))


@query("""
    WITH w AS (SELECT key, lower(title) AS t, lower(regexp_extract(unnest(authors), '([^ ]+)$', 1)) AS surname FROM works WHERE title IS NOT NULL), d AS (SELECT doc_id, lower(title) AS t, lower(regexp_extract(author, '([^ ]+)$', 1)) AS surname FROM documents WHERE title IS NOT NULL AND author IS NOT NULL)
    SELECT DISTINCT d.doc_id, w.key FROM d JOIN w ON d.surname = w.surname AND (starts_with(w.t, substr(d.t, 1, 4)) OR starts_with(d.t, substr(w.t, 1, 4)))
""")
def author_title_lookup(spark, d):
    """Works of the same surname whose title begins alike: an equi-join with a prefix behind it."""
    name = lambda c: F.lower(F.regexp_extract(c, "([^ ]+)$", 1))
    w = table(spark, d, "works").filter("title IS NOT NULL").select("key", F.lower("title").alias("wt"), F.explode("authors").alias("a")).select("key", "wt", name("a").alias("surname"))
    x = table(spark, d, "documents").filter("title IS NOT NULL AND author IS NOT NULL").select("doc_id", F.lower("title").alias("dt"), name("author").alias("surname"))
    return x.join(w, "surname").filter(F.col("wt").startswith(F.substring("dt", 1, 4)) | F.col("dt").startswith(F.substring("wt", 1, 4))).select("doc_id", "key").distinct()


@query("""
    WITH k AS (SELECT doc_id, n_chars, regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') AS slug, lower(author) AS who FROM documents WHERE title IS NOT NULL AND author IS NOT NULL), g AS (SELECT *, row_number() OVER (PARTITION BY slug, who ORDER BY n_chars DESC NULLS LAST, doc_id) AS r, count(*) OVER (PARTITION BY slug, who) AS n FROM k) SELECT doc_id, r > 1 AS loser FROM g WHERE n > 1
""")
def same_metadata(spark, d):
    """Documents of the same title and author; all but the longest lose."""
    k = table(spark, d, "documents").filter("title IS NOT NULL AND author IS NOT NULL").select("doc_id", "n_chars", F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "-").alias("slug"), F.lower("author").alias("who"))
    w = W.partitionBy("slug", "who")
    g = k.withColumn("r", F.row_number().over(w.orderBy(F.desc_nulls_last("n_chars"), "doc_id"))).withColumn("n", F.count("*").over(w))
    return g.filter("n > 1").select("doc_id", (F.col("r") > 1).alias("loser"))


@query("""
    SELECT f.path, d.words, p.action, p.words_out, r.content_type, s.kind, s.priority FROM files f LEFT JOIN docs d ON d.num = f.doc LEFT JOIN (SELECT path, max(action) AS action, max(words_out) AS words_out FROM plan GROUP BY path) p ON p.path = f.path
    LEFT JOIN (SELECT text_path, min(raw_path) AS raw_path FROM jobs WHERE text_path IS NOT NULL GROUP BY 1) j ON j.text_path = f.path LEFT JOIN raws r ON r.raw_path = j.raw_path LEFT JOIN sources s ON s.name = f.source
""")
def page_assembly(spark, d):
    """A file with all that is known of it: five left joins, the widest one last."""
    t = lambda n: table(spark, d, n)
    p = t("plan").groupBy("path").agg(F.max("action").alias("action"), F.max("words_out").alias("words_out"))
    j = t("jobs").filter("text_path IS NOT NULL").groupBy(F.col("text_path").alias("path")).agg(F.min("raw_path").alias("raw_path"))
    f = t("files").select("path", "source", "doc").join(p, "path", "left").join(j, "path", "left").join(t("raws").select("raw_path", "content_type"), "raw_path", "left")
    f = f.join(t("docs").select(F.col("num").alias("doc"), "words"), "doc", "left")
    s = t("sources").select(F.col("name").alias("source"), "kind", "priority")
    return f.join(F.broadcast(s), "source", "left").select("path", "words", "action", "words_out", "content_type", "kind", "priority")  # sources: 26 rows


_TREE = "SELECT user_id * 1000000 + k AS id, CASE WHEN k > 1 THEN user_id * 1000000 + k // 2 END AS parent FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)"


def _tree(spark, d):
    e = table(spark, d, "events").select("user_id", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("k"))
    return e.select((F.col("user_id") * 1000000 + F.col("k")).alias("id"), F.when(F.col("k") > 1, F.col("user_id") * 1000000 + F.floor(F.col("k") / 2)).alias("parent"))


@query(f"WITH RECURSIVE t AS ({_TREE}), r(id, root, depth) AS (SELECT id, id, CAST(0 AS BIGINT) FROM t WHERE parent IS NULL UNION ALL SELECT t.id, r.root, r.depth + 1 FROM t JOIN r ON t.parent = r.id) SELECT * FROM r")
def tree_depths(spark, d):
    """Root and depth of every node of a forest of parent pointers (each user's rows, laid out as a binary tree)."""
    return tree.depths(stored(_tree(spark, d)))


@query(f"WITH t AS ({_TREE}) SELECT id FROM t WHERE id NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)")
def tree_leaves(spark, d):
    return tree.leaves(_tree(spark, d)).select("id")


@query(f"WITH t AS ({_TREE}) SELECT parent AS id, count(*) AS children, min(id) AS first_child FROM t WHERE parent IS NOT NULL GROUP BY parent")
def tree_children(spark, d):
    return _tree(spark, d).filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("children"), F.min("id").alias("first_child"))


@query("SELECT source, count(*) AS files, count(DISTINCT doc) AS texts, count(*) FILTER (WHERE doc IS NULL) AS without FROM files GROUP BY source")
def distinct_texts(spark, d):
    return table(spark, d, "files").groupBy("source").agg(F.count("*").alias("files"), F.countDistinct("doc").alias("texts"), F.count_if(F.col("doc").isNull()).alias("without"))


@query("""
    SELECT date_trunc('day', ts) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, count(DISTINCT user_id) AS users, round(sum(CASE WHEN value > 50 THEN value ELSE 0 END), 2) AS large FROM events GROUP BY 1
""")
def cycle_summary(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.countDistinct("user_id").alias("users"), F.round(F.sum(F.when(F.col("value") > 50, F.col("value")).otherwise(0.0)), 2).alias("large"))


@query("SELECT num, CAST(i AS INTEGER) AS unit, sum(w) OVER (PARTITION BY num ORDER BY i) AS upto, w / sum(w) OVER (PARTITION BY num) AS share FROM (SELECT num, generate_subscripts(unit_words, 1) AS i, unnest(unit_words) AS w FROM docs)")
def running_words(spark, d):
    """Prefix sums of words within a text, from which any range's rate follows."""
    u = table(spark, d, "docs").select("num", F.posexplode("unit_words").alias("i", "w"), F.aggregate("unit_words", F.lit(0), lambda s, x: s + x).alias("all"))
    return u.select("num", (F.col("i") + 1).alias("unit"), F.sum("w").over(W.partitionBy("num").orderBy("i")).alias("upto"), (F.col("w") / F.col("all")).alias("share"))


@query("""
    WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, avg(value) AS v, median(value) AS m FROM events GROUP BY 1, 2), g AS (SELECT event_type, day, v - m AS gap FROM d), s AS (SELECT *, avg(gap) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS g0, avg(gap) OVER (w ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING) AS g1 FROM g WINDOW w AS (PARTITION BY event_type ORDER BY day))
    SELECT event_type, day, CASE WHEN g1 IS NULL THEN 'new' WHEN g0 > g1 + 1 THEN 'widening' WHEN g0 < g1 - 1 THEN 'narrowing' ELSE 'flat' END AS trend FROM s
""")
def gap_trend(spark, d):
    """Whether the gap between two series widens."""
    g = table(spark, d, "events").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg((F.avg("value") - F.median("value")).alias("gap"))
    w = W.partitionBy("event_type").orderBy("day")
    s = g.withColumn("g0", F.avg("gap").over(w.rowsBetween(-2, 0))).withColumn("g1", F.avg("gap").over(w.rowsBetween(-5, -3)))
    return s.select("event_type", "day", F.when(F.col("g1").isNull(), "new").when(F.col("g0") > F.col("g1") + 1, "widening").when(F.col("g0") < F.col("g1") - 1, "narrowing").otherwise("flat").alias("trend"))


@query("SELECT doc_id FROM documents ORDER BY sha256('9:' || doc_id), doc_id LIMIT 100")
def reservoir_sample(spark, d):
    """A hundred documents by a seeded hash: a reservoir's sample that any order of rows gives alike."""
    return table(spark, d, "documents").select("doc_id").orderBy(F.sha2(F.concat_ws(":", F.lit("9"), F.col("doc_id").cast("string")), 256), "doc_id").limit(100)


@query("""
    SELECT 'documents' AS corpus, source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 2 UNION ALL SELECT 'files', source, count(*) FROM files GROUP BY 2 UNION ALL SELECT 'works', source, count(*) FROM works GROUP BY 2
""")
def reading_union(spark, d):
    """All corpora under one schema; columns that one lacks are null."""
    a = table(spark, d, "documents").filter("source IS NOT NULL").select(F.lit("documents").alias("corpus"), "source", "doc_id")
    b = table(spark, d, "files").select(F.lit("files").alias("corpus"), "source", "path")
    c = table(spark, d, "works").select(F.lit("works").alias("corpus"), "source", "key")
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True).groupBy("corpus", "source").agg(F.count("*").alias("n"))


@query("""
    WITH p AS (SELECT path, unnest(string_split(text, chr(10))) AS p FROM files WHERE text IS NOT NULL)
    SELECT path, md5(p) AS para, CAST(regexp_matches(p, '^[A-Z][a-z]+ [A-Z][a-z]+') AS INTEGER) + CAST(regexp_matches(p, '(?i) (?:lives|writes|was born|is the author|teaches|won) ') AS INTEGER) + CAST(regexp_matches(p, '(?i)novel|stories|award|magazine|book') AS INTEGER) AS score FROM p WHERE length(p) BETWEEN 20 AND 1500 AND regexp_matches(p, '(?i)novel|stories|award|magazine|book')
""")
def bio_scores(spark, d):
    """Paragraphs that speak of a writer: name first, a verb of lives, words of the trade."""
    p = table(spark, d, "files").filter("text IS NOT NULL").select("path", F.explode(F.split("text", "\n")).alias("p")).filter(F.length("p").between(20, 1500) & F.col("p").rlike("(?i)novel|stories|award|magazine|book"))
    n = lambda rx: F.col("p").rlike(rx).cast("int")
    return p.select("path", F.md5("p").alias("para"), (n("^[A-Z][a-z]+ [A-Z][a-z]+") + n("(?i) (?:lives|writes|was born|is the author|teaches|won) ") + n("(?i)novel|stories|award|magazine|book")).alias("score"))


@query("""
    SELECT key, regexp_replace(regexp_replace(name, '^.*--', ''), '(?:-[0-9]+)?[.]txt$', '') AS display, CAST(nullif(regexp_extract(name, '-([0-9]+)[.]txt$', 1), '') AS INTEGER) AS number FROM works
""")
def display_names(spark, d):
    """Names without folders, suffixes and running numbers."""
    w = table(spark, d, "works")
    return w.select("key", F.regexp_replace(F.regexp_replace("name", "^.*--", ""), "(?:-[0-9]+)?[.]txt$", "").alias("display"), F.nullif(F.regexp_extract("name", "-([0-9]+)[.]txt$", 1), F.lit("")).cast("int").alias("number"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d-%H%M') AS name, strptime(strftime(ts, '%Y-%m-%d-%H%M'), '%Y-%m-%d-%H%M') AS back FROM events")
def time_names(spark, d):
    """Times as sortable names and back."""
    n = F.date_format("ts", "yyyy-MM-dd-HHmm")
    return table(spark, d, "events").select("event_id", n.alias("name"), F.to_timestamp(n, "yyyy-MM-dd-HHmm").alias("back"))


@query("""
    SELECT event_id, ln(1 + value) AS lg, 0.5 * (1 + cos(pi() * least(value, 100) / 100)) AS cosine, 0.2 + 0.8 * (event_id % 10) / 9 AS warmth FROM events
""")
def math_columns(spark, d):
    """Logarithms, a cosine schedule and evenly spaced temperatures."""
    return table(spark, d, "events").select("event_id", F.log1p("value").alias("lg"), (0.5 * (1 + F.cos(F.lit(3.141592653589793) * F.least("value", F.lit(100.0)) / 100))).alias("cosine"), (0.2 + 0.8 * (F.col("event_id") % 10) / 9).alias("warmth"))


@query("""
    WITH u AS (SELECT num, generate_subscripts(hashes, 1) AS i, unnest(hashes) <> 0 AS keep FROM docs), g AS (SELECT num, i, i - row_number() OVER (PARTITION BY num ORDER BY i) AS island FROM u WHERE keep) SELECT num, min(i) - 1 AS from_unit, max(i) AS to_unit FROM g GROUP BY num, island
""")
def keep_runs(spark, d):
    """Runs of units with words, as half-open ranges: run lengths of a keep mask."""
    u = table(spark, d, "docs").select("num", F.posexplode("hashes").alias("i", "h")).filter("h <> 0")
    g = u.withColumn("island", F.col("i") - F.row_number().over(W.partitionBy("num").orderBy("i")))
    return g.groupBy("num", "island").agg(F.min("i").alias("from_unit"), (F.max("i") + 1).alias("to_unit")).drop("island")


@query("SELECT num, unit_words FROM docs")
def encoded_units(spark, d):
    """The words of each unit, worked out from the texts again: the non-blank lines of what the index holds, 0 for scene breaks."""
    f = table(spark, d, "files").filter("doc IS NOT NULL AND text IS NOT NULL").groupBy(F.col("doc").alias("num")).agg(F.min(F.struct("path", "text")).alias("t"))
    lines = F.filter(F.split("t.text", "\n"), lambda x: F.regexp_replace(x, r"(?U)\s", "") != "")
    units = f.select("num", lines.alias("l")).select("num", F.transform("l", lambda x: F.when(x.rlike(r"[\p{L}\p{N}]"), F.size(F.filter(F.split(x, r"(?U)\s+"), lambda w: w != ""))).otherwise(0)).alias("unit_words"))
    return units.join(table(spark, d, "docs").select("num"), "num", "left_semi")


@query("""
    SELECT DISTINCT least(a.path, b.path) AS x, greatest(a.path, b.path) AS y, floor(matched_words * (1 - common_discount)) + 7 AS effective, floor(matched_words * (1 - common_discount)) >= 100 AS enough FROM pairs WHERE a.path <> b.path AND matched_words IS NOT NULL AND common_discount IS NOT NULL
""")
def discounted_matches(spark, d):
    """Matched words less the share that common runs make up."""
    e = F.floor(F.col("matched_words") * (1 - F.col("common_discount")))
    return table(spark, d, "pairs").filter("a.path <> b.path AND matched_words IS NOT NULL AND common_discount IS NOT NULL").select(F.least("a.path", "b.path").alias("x"), F.greatest("a.path", "b.path").alias("y"), (e + 7).alias("effective"), (e >= 100).alias("enough")).distinct()


_SHARED_UNITS = "u AS (SELECT num, generate_subscripts(hashes, 1) AS i, unnest(hashes) AS h, unnest(unit_words) AS w, unnest(ends) AS e FROM docs), k AS (SELECT h FROM (SELECT DISTINCT num, h FROM u WHERE h <> 0) GROUP BY h HAVING count(*) BETWEEN 2 AND 6)"


def _placed_units(spark, d):
    u = table(spark, d, "docs").select("num", F.posexplode(F.arrays_zip("hashes", "unit_words", "ends")).alias("i", "x"))
    return u.select("num", (F.col("i") + 1).alias("i"), F.col("x.hashes").alias("h"), F.col("x.unit_words").alias("w"), F.col("x.ends").alias("e")).filter("h <> 0")


def _blocks(p):
    """Matched units (a, b, i, w, e) of a joined to blocks."""
    w = W.partitionBy("a", "b").orderBy("i")
    s = p.withColumn("cut", F.when(F.col("e") - F.col("w") - F.lag("e").over(w) <= 300, 0).otherwise(1)).withColumn("block", F.sum("cut").over(w))
    return s.groupBy("a", "b", "block").agg(F.min("i").alias("from_unit"), F.max("i").alias("to_unit"), F.sum("w").alias("held"), (F.max("e") - F.min(F.col("e") - F.col("w"))).alias("words"))


@query(f"""
    WITH {_SHARED_UNITS}, m AS (SELECT u.* FROM u JOIN k USING (h)), p AS (SELECT DISTINCT a.num AS a, b.num AS b, a.i, a.w, a.e FROM m a JOIN m b ON a.h = b.h AND a.num <> b.num),
    g AS (SELECT *, CASE WHEN e - w - lag(e) OVER (PARTITION BY a, b ORDER BY i) <= 300 THEN 0 ELSE 1 END AS cut FROM p), s AS (SELECT *, sum(cut) OVER (PARTITION BY a, b ORDER BY i) AS block FROM g)
    SELECT a, b, block, min(i) AS from_unit, max(i) AS to_unit, sum(w) AS held, max(e) - min(e - w) AS words FROM s GROUP BY 1, 2, 3
""")
def match_blocks(spark, d):
    """Blocks of a text that another holds: matched units joined over gaps of at most 300 words, with the words held and those in between.

    Only units of two to six texts match, as in the SQL; pair_blocks has no such rule."""
    u = _placed_units(spark, d)
    k = u.select("num", "h").distinct().groupBy("h").agg(F.count("*").alias("c")).filter("c BETWEEN 2 AND 6").select("h")
    m = stored(u.join(k, "h"))
    p = m.alias("x").join(m.alias("y"), F.expr("x.h = y.h AND x.num <> y.num")).select(F.col("x.num").alias("a"), F.col("y.num").alias("b"), "x.i", "x.w", "x.e").distinct()
    return _blocks(p)


@query()
def pair_blocks(spark, d):
    """Blocks as in match_blocks for the texts of every matched pair of files, in both directions, by units of any number of texts."""
    f = table(spark, d, "files").filter("doc IS NOT NULL").select("path", "doc").distinct()
    p = table(spark, d, "pairs").select(F.col("a.path").alias("p"), F.col("b.path").alias("q")).distinct()
    p = p.join(f.select(F.col("path").alias("p"), F.col("doc").alias("x")), "p").join(f.select(F.col("path").alias("q"), F.col("doc").alias("y")), "q").filter("x <> y")
    p = stored(p.select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")), F.struct(F.col("y").alias("a"), F.col("x").alias("b")))).alias("s")).select("s.a", "s.b").distinct())
    u = _placed_units(spark, d)
    have = p.join(u.select(F.col("num").alias("b"), "h").distinct(), "b")
    return _blocks(p.join(u.withColumnRenamed("num", "a"), "a").join(have, ["a", "b", "h"], "left_semi").select("a", "b", "i", "w", "e"))


@query("""
    SELECT r.raw_path, regexp_extract(body, '<title>([^<|]*)', 1) AS page_title, j.title FROM raws r JOIN (SELECT raw_path, min(json_extract_string(metadata, '$.title')) AS title FROM jobs WHERE raw_path IS NOT NULL AND json_extract_string(metadata, '$.title') IS NOT NULL GROUP BY 1) j ON j.raw_path = r.raw_path
    WHERE regexp_matches(body, '<title>') AND regexp_replace(lower(regexp_extract(body, '<title>([^<|]*)', 1)), '[^a-z0-9]', '', 'g') <> regexp_replace(lower(j.title), '[^a-z0-9]', '', 'g')
""")
def foreign_pages(spark, d):
    """Pages whose own title disagrees with the ledger's."""
    j = table(spark, d, "jobs").filter("raw_path IS NOT NULL").select("raw_path", F.get_json_object("metadata", "$.title").alias("title")).filter("title IS NOT NULL").groupBy("raw_path").agg(F.min("title").alias("title"))
    r = table(spark, d, "raws").filter(F.col("body").contains("<title>")).select("raw_path", F.regexp_extract("body", "<title>([^<|]*)", 1).alias("page_title"))
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    return r.join(j, "raw_path").filter(plain("page_title") != plain("title")).select("raw_path", "page_title", "title")


@query("""
    WITH p AS (SELECT raw_path, unnest(regexp_extract_all(body, '(?s)<(?:p|div|td|li)[^>]*>([^<]+)', 1)) AS cell FROM raws WHERE body IS NOT NULL) SELECT raw_path, max(length(cell)) AS longest, count(*) AS cells FROM p GROUP BY raw_path
""")
def longest_cells(spark, d):
    """The longest cell of a page: what is taken where no selector fits."""
    p = table(spark, d, "raws").filter("body IS NOT NULL").select("raw_path", F.explode(F.regexp_extract_all("body", F.lit("(?s)<(?:p|div|td|li)[^>]*>([^<]+)"), F.lit(1))).alias("cell"))
    return p.groupBy("raw_path").agg(F.max(F.length("cell")).alias("longest"), F.count("*").alias("cells"))


@query("""
    SELECT f.path, CASE WHEN p.action = 'drop' THEN 'dropped' WHEN p.action IS NULL THEN 'ungraded' ELSE 'kept' END AS grade, CASE WHEN p.action = 'edit' AND p.reason IS NOT NULL THEN p.reason ELSE s.kind END AS origin
    FROM files f LEFT JOIN (SELECT path, max(action) AS action, max(reason) AS reason FROM plan GROUP BY path) p ON p.path = f.path LEFT JOIN sources s ON s.name = f.source
""")
def graded_files(spark, d):
    """Grades joined to files; what the grade says of the origin holds only with a reason."""
    p = table(spark, d, "plan").groupBy("path").agg(F.max("action").alias("action"), F.max("reason").alias("reason"))
    s = table(spark, d, "sources").select(F.col("name").alias("source"), "kind")
    f = table(spark, d, "files").select("path", "source").join(p, "path", "left").join(F.broadcast(s), "source", "left")  # sources: 26 rows
    return f.select("path", F.when(F.col("action") == "drop", "dropped").when(F.col("action").isNull(), "ungraded").otherwise("kept").alias("grade"), F.when((F.col("action") == "edit") & F.col("reason").isNotNull(), F.col("reason")).otherwise(F.col("kind")).alias("origin"))


@query("""
    SELECT path, CASE WHEN text IS NULL THEN 'unreadable' WHEN regexp_matches(lower(text), 'all rights reserved|copyright') AND length(text) < 400 THEN 'notice' WHEN regexp_matches(lower(text), 'to be continued|read the rest') THEN 'teaser' WHEN length(text) < 300 THEN 'too short' WHEN regexp_matches(text, '[\\p{Cyrillic}]') THEN 'not english' ELSE 'ok' END AS status FROM files
""")
def status_chain(spark, d):
    """One status by an ordered chain of tests."""
    t, l, n = F.col("text"), F.lower("text"), F.length("text")
    s = F.when(t.isNull(), "unreadable").when(l.rlike("all rights reserved|copyright") & (n < 400), "notice").when(l.rlike("to be continued|read the rest"), "teaser").when(n < 300, "too short").when(t.rlike(r"[\p{IsCyrillic}]"), "not english").otherwise("ok")
    return table(spark, d, "files").select("path", s.alias("status"))


@query("""
    WITH have AS (SELECT text_path AS path FROM jobs WHERE text_path IS NOT NULL UNION SELECT path FROM plan), r AS (SELECT raw_path, source FROM raws), n AS (SELECT path FROM files) SELECT path FROM n WHERE path NOT IN (SELECT path FROM have WHERE path IS NOT NULL) ORDER BY path LIMIT 50
""")
def back_catalogue(spark, d):
    """Files that neither of two stores knows, the first fifty by name."""
    have = table(spark, d, "jobs").select(F.col("text_path").alias("path")).filter("path IS NOT NULL").union(table(spark, d, "plan").select("path"))
    return table(spark, d, "files").select("path").join(have, "path", "left_anti").orderBy("path").limit(50)


@query("""
    WITH l AS (SELECT path, generate_subscripts(ls, 1) AS n, unnest(ls) AS before FROM (SELECT path, string_split(text, chr(10)) AS ls FROM files WHERE text IS NOT NULL)), a AS (SELECT *, trim(regexp_replace(before, '[ \\t\\r]+', ' ', 'g'), ' ') AS after FROM l)
    SELECT path, CAST(n AS INTEGER) AS line_no, md5(before) AS before, md5(after) AS after FROM a WHERE before <> after
""")
def edit_audit(spark, d):
    """What a cleaner changed: line by line, before and after."""
    l = table(spark, d, "files").filter("text IS NOT NULL").select("path", F.posexplode(F.split("text", "\n")).alias("n", "b")).withColumn("a", F.trim(F.regexp_replace("b", r"[ \t\r]+", " ")))
    return l.filter("a <> b").select("path", (F.col("n") + 1).alias("line_no"), F.md5("b").alias("before"), F.md5("a").alias("after"))


@query("SELECT label, count(*) AS n, count(*) FILTER (WHERE embedding[1] > 0) AS good, avg(CAST(embedding[1] AS DOUBLE)) AS mean FROM embeddings GROUP BY label")
def label_tally(spark, d):
    x = F.element_at("embedding", 1).cast("double")
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.count_if(x > 0).alias("good"), F.avg(x).alias("mean"))


@query("""
    WITH b AS (SELECT vec_id, label, substr(sha1('blind:' || vec_id), 1, 6) AS blind FROM embeddings), p AS (SELECT substr(sha1('blind:' || vec_id), 1, 6) AS blind, embedding[2] > 0 AS pick FROM embeddings WHERE vec_id % 3 = 0) SELECT b.label, count(*) AS rows, count(p.blind) AS shown, count(*) FILTER (WHERE p.pick) AS picked FROM b LEFT JOIN p USING (blind) GROUP BY b.label
""")
def picks_by_label(spark, d):
    """Picks joined to rows by their blind ids, added up with conditions."""
    e = table(spark, d, "embeddings").withColumn("blind", F.substring(F.sha1(F.concat_ws(":", F.lit("blind"), F.col("vec_id").cast("string"))), 1, 6))
    p = e.filter("vec_id % 3 = 0").select("blind", (F.element_at("embedding", 2) > 0).alias("pick"), F.lit(1).alias("there"))
    return e.join(p, "blind", "left").groupBy("label").agg(F.count("*").alias("rows"), F.count("there").alias("shown"), F.count_if("pick").alias("picked"))


@query("""
    WITH g AS (SELECT list(DISTINCT genre) AS genres FROM documents WHERE genre IS NOT NULL), c AS (SELECT doc_id, list_transform(string_split(concat_ws(', ', title, author, genre), ','), lambda x: trim(x)) AS p FROM documents),
    k AS (SELECT doc_id, p, greatest(1, coalesce(list_max(list_filter(range(1, len(p) + 1), lambda i: NOT list_contains(genres, p[i]))), 1)) AS n FROM c, g)
    SELECT doc_id, array_to_string(p[:n], ', ') AS category, array_to_string(p[n + 1:], ', ') AS genres FROM k
""")
def category_split(spark, d):
    """A category of names apart by commas, without the genres at its end: whatever the table of genres holds, up to the first name that is none."""
    docs = table(spark, d, "documents")
    genres = docs.filter("genre IS NOT NULL").agg(F.collect_set("genre").alias("known"))
    c = docs.select("doc_id", F.transform(F.split(F.concat_ws(", ", "title", "author", "genre"), ","), lambda x: F.trim(x)).alias("p")).join(F.broadcast(genres))  # one row: the dimension
    last = F.array_max(F.filter(F.sequence(F.lit(1), F.size("p")), lambda i: ~F.array_contains("known", F.get("p", i - 1))))
    k = c.select("doc_id", "p", F.greatest(F.coalesce(last, F.lit(1)), F.lit(1)).alias("n"))
    return k.select("doc_id", F.array_join(F.slice("p", F.lit(1), F.col("n")), ", ").alias("category"), F.array_join(F.slice("p", F.col("n") + 1, F.size("p")), ", ").alias("genres"))


@query()
def token_counts(spark, d):
    """Tokens of each work by an installed library, beside what the shelf says."""
    return table(spark, d, "works").select("key", "words", F.col("tokens").alias("declared"), tokens.token_count("text").alias("counted"))
