"""Exact and near duplicates, containment, boilerplate, plans and their reports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import graph, near
from lexmill.plans.catalog import query
from lexmill.scale import salted_lookup, stored, table


@query("SELECT path, min(path) OVER (PARTITION BY md5(text)) AS leader, count(*) OVER (PARTITION BY md5(text)) AS copies FROM files WHERE text <> ''")
def exact_dups(spark, d):
    """Files with the first path that has the same text."""
    f = table(spark, d, "files").filter("text <> ''").select("path", F.md5("text").alias("h"))
    g = stored(f.groupBy("h").agg(F.min("path").alias("leader"), F.count("*").alias("copies")))
    return salted_lookup(f, g, "h", spread=F.col("path")).select("path", "leader", "copies")


@query("""
    WITH h AS (SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS h FROM documents WHERE text IS NOT NULL), g AS (SELECT h, min(doc_id) AS first_id, count(*) AS n FROM h GROUP BY h) SELECT doc_id, first_id FROM h JOIN g USING (h) WHERE doc_id <> first_id
""")
def fingerprint_dups(spark, d):
    """Texts equal but for white space: all but the first."""
    h = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.md5(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("h"))
    first = stored(h.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    return salted_lookup(h, first, "h", spread=F.col("doc_id")).filter("doc_id <> first_id").select("doc_id", "first_id")


_LINES = "SELECT path, generate_subscripts(string_split(text, chr(10)), 1) AS n, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM files WHERE text IS NOT NULL"


def _lines(spark, d):
    return table(spark, d, "files").filter("text IS NOT NULL").select("path", F.posexplode(F.split("text", "\n")).alias("n", "line")).select("path", (F.col("n") + 1).alias("n"), F.trim("line").alias("line"))


@query(f"""
    WITH l AS ({_LINES}), k AS (SELECT * FROM l WHERE len(list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')) >= 8), f AS (SELECT line, min((path, n)) AS one FROM k GROUP BY line)
    SELECT path, CAST(n AS INTEGER) AS line_no FROM k JOIN f USING (line) WHERE (path, n) <> one
""")
def line_dups_global(spark, d):
    """Longer lines that an earlier place of the corpus has, by path and line."""
    k = _lines(spark, d).filter(F.size(X.ws_words("line")) >= 8).select("path", "n", F.md5("line").alias("h"))
    first = stored(k.groupBy("h").agg(F.min(F.struct("path", "n")).alias("one"), F.count("*").alias("c")).filter("c > 1").drop("c"))
    return salted_lookup(k, first, "h", spread=F.col("path")).filter(F.struct("path", "n") != F.col("one")).select("path", F.col("n").alias("line_no"))


@query(f"""
    WITH l AS ({_LINES}), k AS (SELECT * FROM l WHERE len(list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')) >= 8), f AS (SELECT line, min(path) AS one FROM k GROUP BY line)
    SELECT path, count(*) AS n, count(*) FILTER (WHERE one < path) AS taken, count(*) FILTER (WHERE one < path) >= 0.6 * count(*) AS duplicate FROM k JOIN f USING (line) GROUP BY path
""")
def paragraph_overlap_share(spark, d):
    """How much of a file's longer lines stands in an earlier file, duplicates among those; paragraph_overlap_greedy goes by kept files."""
    k = _lines(spark, d).filter(F.size(X.ws_words("line")) >= 8).select("path", F.md5("line").alias("h"))
    # lines of one path only are taken by nobody, so only the others' first paths are looked up
    f = stored(k.groupBy("h").agg(F.min("path").alias("one"), F.max("path").alias("last")).filter("one < last").drop("last"))
    g = salted_lookup(k, f, "h", "left", spread=F.col("path")).groupBy("path").agg(F.count("*").alias("n"), F.count_if(F.col("one") < F.col("path")).alias("taken"))
    return g.withColumn("duplicate", F.col("taken") >= 0.6 * F.col("n"))


@query()
def paragraph_overlap_greedy(spark, d):
    """How much of a file's longer lines stands in longer files that are kept; from three fifths on the file is a duplicate and takes no lines itself."""
    from lexmill.operators.decide import decide_units

    k = _lines(spark, d).filter("path IS NOT NULL").select("path", F.size(X.ws_words("line")).alias("words"), F.md5("line").alias("unit"))
    long = k.filter("words >= 8").groupBy("path", "unit").agg(F.count("*").alias("times"))
    files = k.groupBy("path").agg(F.sum("words").alias("all"), F.count_if(F.col("words") >= 8).alias("n")).filter("n > 0")
    # of equal lengths the first path ranks highest: its letters count downwards, and its end above any letter
    first = F.concat(F.transform(F.split("path", ""), lambda c: -F.ascii(c)), F.array(F.lit(1)))
    nodes = stored(files.select(F.col("path").alias("id"), F.struct("all", first.alias("first")).alias("rank"), F.col("n").alias("words"), F.lit(False).alias("reference")))
    fate = decide_units(nodes, long.select(F.col("path").alias("id"), "unit", F.col("times").alias("words")), F.col("covered") >= 0.6 * F.col("words"))
    return fate.join(nodes, "id").select(F.col("id").alias("path"), F.col("words").alias("n"), F.col("covered").alias("taken"), (F.col("fate") == "drop").alias("duplicate"))


@query("""
    WITH b AS (SELECT num, words, array_to_string(list_filter(hashes, lambda x: x <> 0), ',') AS body FROM docs), g AS (SELECT body, count(*) AS n, arg_max(num, (words, -num)) AS leader FROM b WHERE body <> '' GROUP BY body HAVING count(*) >= 2) SELECT num, leader FROM b JOIN g USING (body)
""")
def equal_bodies(spark, d):
    """Texts whose units have the same hashes, with the leader of each group: the most words, then the smallest number."""
    b = table(spark, d, "docs").select("num", "words", F.filter("hashes", lambda x: x != 0).alias("h")).filter("size(h) > 0")
    b = b.select("num", "words", F.struct(F.xxhash64("h"), F.hash("h"), F.size("h")).alias("body"))
    g = b.groupBy("body").agg(F.count("*").alias("n"), F.max_by("num", F.struct("words", -F.col("num"))).alias("leader")).filter("n >= 2")
    return b.join(g, "body").select("num", "leader")


@query("""
    WITH g AS (SELECT f.path, f.source, row_number() OVER (PARTITION BY f.doc ORDER BY CASE s.kind WHEN 'read' THEN 2 WHEN 'incoming' THEN 1 ELSE 0 END DESC, s.priority DESC, s.rough, NOT s.container, f.path) AS k, f.doc FROM files f JOIN sources s ON s.name = f.source WHERE f.doc IS NOT NULL) SELECT path, doc, k AS rank FROM g
""")
def leader_order(spark, d):
    """The order in which copies of a text are kept: kind, priority, clean before rough, containers first, path."""
    s = table(spark, d, "sources").select(F.col("name").alias("source"), F.when(F.col("kind") == "read", 2).when(F.col("kind") == "incoming", 1).otherwise(0).alias("kind_rank"), "priority", "rough", "container")
    f = table(spark, d, "files").filter("doc IS NOT NULL").select("path", "source", "doc").join(F.broadcast(s), "source")  # sources: 26 rows
    w = W.partitionBy("doc").orderBy(F.desc("kind_rank"), F.desc("priority"), "rough", ~F.col("container"), "path")
    return f.select("path", "doc", F.row_number().over(w).alias("rank"))


_UNITS = """
    u AS (SELECT source, num, generate_subscripts(hashes, 1) - 1 AS i, unnest(hashes) AS h, unnest(prefixes) AS pre, unnest(unit_words) AS uw, unnest(list_zip(ends, list_concat([0], ends))) AS e, len(hashes) AS n
          FROM docs JOIN (SELECT doc, min(source) AS source FROM files WHERE doc IS NOT NULL GROUP BY doc) f ON f.doc = docs.num WHERE len(hashes) > 0),
    z AS (SELECT *, e[1] - e[2] AS codes, CASE WHEN i < least(12, (n + 1) // 2) THEN 'head' WHEN i >= n - least(12, n // 2) THEN 'tail' ELSE 'inside' END AS zone FROM u),
    total AS (SELECT source, count(DISTINCT num) AS of FROM z GROUP BY source)
"""


def _units(spark, d):
    """One row for each unit with its zone: the first and last twelve, which never overlap, and what is between."""
    first = table(spark, d, "files").filter("doc IS NOT NULL").groupBy(F.col("doc").alias("num")).agg(F.min("source").alias("source"))
    u = table(spark, d, "docs").filter("size(hashes) > 0").select("num", F.size("hashes").alias("n"), "ends", F.posexplode(F.arrays_zip("hashes", "prefixes", "unit_words", "ends")).alias("i", "x"))
    before = F.when(F.col("i") > 0, F.element_at("ends", F.greatest(F.col("i"), F.lit(1)))).otherwise(0)
    u = u.select("num", "i", "n", F.col("x.hashes").alias("h"), F.col("x.prefixes").alias("pre"), F.col("x.unit_words").alias("uw"), (F.col("x.ends") - before).alias("codes"))
    zone = F.when(F.col("i") < F.least(F.lit(12), F.floor((F.col("n") + 1) / 2)), "head").when(F.col("i") >= F.col("n") - F.least(F.lit(12), F.floor(F.col("n") / 2)), "tail").otherwise("inside")
    return u.join(first, "num").withColumn("zone", zone)


def _boilerplate(spark, d, key: str, ok, least: int, share: float, edge: float):
    u = _units(spark, d)
    of = u.groupBy("source").agg(F.countDistinct("num").alias("of"))
    # one row for each document and key first: a key that a third of all units share is added up before the shuffle
    seen = u.filter(ok).groupBy("source", key, "num").agg(F.max(F.when(F.col("zone") == "head", 1).otherwise(0)).alias("head"), F.max(F.when(F.col("zone") == "tail", 1).otherwise(0)).alias("tail"), F.max(F.when(F.col("zone") == "inside", 1).otherwise(0)).alias("inside"))
    g = seen.groupBy("source", key).agg(F.sum("head").alias("head"), F.sum("tail").alias("tail"), F.sum("inside").alias("inside")).join(of, "source")
    rows = g.select("source", key, "of", "inside", F.explode(F.array(F.struct(F.lit("head").alias("zone"), F.col("head").alias("docs")), F.struct(F.lit("tail").alias("zone"), F.col("tail").alias("docs")))).alias("z"))
    rows = rows.select("source", key, F.col("z.zone").alias("zone"), F.col("z.docs").alias("docs"), "inside", "of")
    return rows.filter((F.col("docs") >= F.greatest(F.lit(least), F.ceil(F.col("of") * share))) & (F.col("docs") >= edge * (F.col("docs") + F.col("inside")))).select("source", key, "zone", "docs")


def _boilerplate_sql(key: str, ok: str, least: int, share: float, edge: float) -> str:
    return f"""WITH {_UNITS}, g AS (SELECT source, {key}, count(DISTINCT num) FILTER (WHERE zone = 'head') AS head, count(DISTINCT num) FILTER (WHERE zone = 'tail') AS tail, count(DISTINCT num) FILTER (WHERE zone = 'inside') AS inside FROM z WHERE {ok} GROUP BY 1, 2),
    r AS (SELECT source, {key}, 'head' AS zone, head AS docs, inside FROM g UNION ALL SELECT source, {key}, 'tail', tail, inside FROM g)
    SELECT r.source, r.{key}, zone, docs FROM r JOIN total USING (source) WHERE docs >= greatest({least}, ceil("of" * {share})) AND docs >= {edge} * (docs + inside)"""


@query(_boilerplate_sql("h", "h <> 0 AND codes >= 4", 4, 0.005, 0.9))
def boilerplate_identical(spark, d):
    """Units that stand at the same edge of many of a source's texts and hardly within them."""
    return _boilerplate(spark, d, "h", "h <> 0 AND codes >= 4", 4, 0.005, 0.9)


@query(_boilerplate_sql("pre", "pre <> 0 AND uw <= 60", 10, 0.02, 0.95))
def boilerplate_templates(spark, d):
    """The same by the key of their first two words."""
    return _boilerplate(spark, d, "pre", "pre <> 0 AND uw <= 60", 10, 0.02, 0.95)


@query("""
    WITH s AS (SELECT num, unnest(sample) AS h, len(sample) AS n FROM docs), g AS (SELECT h FROM (SELECT DISTINCT num, h FROM s) GROUP BY h HAVING count(*) BETWEEN 2 AND 19), k AS (SELECT DISTINCT num, s.h, n FROM s JOIN g ON g.h = s.h)
    SELECT a.num AS a, b.num AS b, count(*) AS shared FROM k a JOIN k b ON a.h = b.h AND a.num < b.num GROUP BY a.num, b.num, a.n, b.n HAVING count(*) >= 2 AND (count(*) * 8 >= 50 OR count(*) >= 0.25 * least(a.n, b.n))
""")
def candidate_pairs(spark, d):
    """Pairs that share sampled runs. By its definition a run of 20 or more texts is common and proposes nothing, so a run makes at most 171 pairs."""
    s = table(spark, d, "docs").select("num", F.size("sample").alias("n"), F.explode(F.array_distinct("sample")).alias("h"))
    few = s.groupBy("h").agg(F.count("*").alias("c")).filter("c BETWEEN 2 AND 19").select("h")
    k = stored(s.join(few, "h"))
    p = k.alias("x").join(k.alias("y"), F.expr("x.h = y.h AND x.num < y.num")).groupBy(F.col("x.num").alias("a"), F.col("y.num").alias("b"), F.least("x.n", "y.n").alias("n")).agg(F.count("*").alias("shared"))
    return p.filter("shared >= 2 AND (shared * 8 >= 50 OR shared >= 0.25 * n)").select("a", "b", "shared")


@query("SELECT h, count(DISTINCT num) AS docs FROM (SELECT num, unnest(sample) AS h FROM docs) GROUP BY h HAVING count(DISTINCT num) >= 20")
def common_shingles(spark, d):
    return table(spark, d, "docs").select("num", F.explode(F.array_distinct("sample")).alias("h")).groupBy("h").agg(F.count("*").alias("docs")).filter("docs >= 20")


_SETS = """
    w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS e FROM w, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(e, '|' ORDER BY e)) AS h FROM g GROUP BY doc_id), c AS (SELECT h, min(doc_id) AS class FROM n GROUP BY h)
"""


@query(f"""
    WITH {_SETS}, r AS (SELECT g.doc_id, e, n FROM g JOIN n USING (doc_id) JOIN c ON c.class = g.doc_id), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s, a.n AS na, b.n AS nb FROM r a JOIN r b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY ALL)
    SELECT a, b, s / (na + nb - s) AS jaccard FROM p WHERE s >= 0.8 * (na + nb - s)
""")
def near_duplicate_pairs(spark, d):
    """Pairs of class representatives with a Jaccard of 0.8 or more over runs of five words; near_duplicate_classes has the members."""
    sets = stored(near.shingle_sets(table(spark, d, "documents"), "doc_id"))
    heads = near.classes(sets).filter("key = class").select("key")
    return near.similar_pairs(sets.join(heads, "key", "left_semi"))


@query(f"WITH {_SETS} SELECT doc_id, class FROM n JOIN c USING (h)")
def near_duplicate_classes(spark, d):
    sets = stored(near.shingle_sets(table(spark, d, "documents"), "doc_id"))
    return near.classes(sets).select(F.col("key").alias("doc_id"), "class")


_CLEAN = "a.path IS NOT NULL AND b.path IS NOT NULL AND a.path <> b.path"


@query(f"""
    WITH p AS (SELECT DISTINCT least(a.path, b.path) AS x, greatest(a.path, b.path) AS y, greatest(of_a, of_b) AS hi, least(of_a, of_b) AS lo, matched_words AS m FROM pairs WHERE {_CLEAN})
    SELECT x, y, CASE WHEN m < 100 THEN 'dropped' WHEN lo >= 0.75 THEN 'same work' WHEN hi >= 0.8 THEN 'contained' WHEN hi >= 0.2 OR m >= 500 THEN 'ambiguous' ELSE 'dropped' END AS verdict FROM p WHERE hi IS NOT NULL AND m IS NOT NULL
""")
def pair_verdicts(spark, d):
    """The verdict on a pair by how much each side holds of the other."""
    p = table(spark, d, "pairs").filter(_CLEAN).select(F.least("a.path", "b.path").alias("x"), F.greatest("a.path", "b.path").alias("y"), F.greatest("of_a", "of_b").alias("hi"), F.least("of_a", "of_b").alias("lo"), F.col("matched_words").alias("m")).distinct()
    v = F.when(F.col("m") < 100, "dropped").when(F.col("lo") >= 0.75, "same work").when(F.col("hi") >= 0.8, "contained").when((F.col("hi") >= 0.2) | (F.col("m") >= 500), "ambiguous").otherwise("dropped")
    return p.filter("hi IS NOT NULL AND m IS NOT NULL").select("x", "y", v.alias("verdict"))


@query(f"""
    SELECT least(a.source, b.source) AS x, greatest(a.source, b.source) AS y, sum(matched_words) AS words, count(*) AS pairs FROM (SELECT DISTINCT least(a.path, b.path) AS k, greatest(a.path, b.path) AS l, CASE WHEN a.path < b.path THEN a ELSE b END AS a, CASE WHEN a.path < b.path THEN b ELSE a END AS b, matched_words FROM pairs WHERE {_CLEAN}) GROUP BY 1, 2
""")
def overlap_matrix(spark, d):
    """Source by source, unordered; a pair that was written twice counts once."""
    p = table(spark, d, "pairs").filter(_CLEAN).select(F.when(F.col("a.path") < F.col("b.path"), F.col("a")).otherwise(F.col("b")).alias("p"), F.when(F.col("a.path") < F.col("b.path"), F.col("b")).otherwise(F.col("a")).alias("q"), "matched_words").distinct()
    return p.groupBy(F.least("p.source", "q.source").alias("x"), F.greatest("p.source", "q.source").alias("y")).agg(F.sum("matched_words").alias("words"), F.count("*").alias("pairs"))


@query(f"""
    WITH RECURSIVE l AS (SELECT a.path AS a, b.path AS b FROM pairs WHERE relation = 'contained' AND {_CLEAN}), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r(v, s) AS (SELECT a, a FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.s = e.a) SELECT v AS path, min(s) AS cluster FROM r GROUP BY v
""")
def containment_clusters(spark, d):
    """Records joined by containment, each with the least record of its cluster."""
    p = table(spark, d, "pairs").filter("relation = 'contained'").select("a.path", "b.path").toDF("a", "b")
    return graph.components(p).select(F.col("v").alias("path"), F.col("label").alias("cluster"))


@query("""
    WITH p AS (SELECT DISTINCT source, path, action, reason, words, words_out, strip.words AS strip_words, list_sum(list_transform(cuts, lambda c: c.words)) AS cut FROM plan)
    SELECT coalesce(source, 'all') AS source, sum(words) AS words_in, sum(CASE WHEN action = 'drop' AND reason <> 'nothing but boilerplate' THEN words ELSE 0 END) AS dup, coalesce(sum(cut), 0) AS cut, sum(CASE WHEN action = 'edit' THEN coalesce(strip_words, 0) WHEN reason = 'nothing but boilerplate' THEN words ELSE 0 END) AS boilerplate, sum(words_out) AS words_out FROM p GROUP BY ROLLUP (source)
""")
def report_by_source(spark, d):
    """Words in, duplicate, cut, boilerplate and out of each source, with a total."""
    p = table(spark, d, "plan").select("source", "path", "action", "reason", "words", "words_out", F.col("strip.words").alias("strip_words"), F.aggregate("cuts", F.lit(0), lambda s, c: s + c["words"]).alias("cut")).distinct()
    return p.rollup("source").agg(
        F.sum("words").alias("words_in"), F.sum(F.when((F.col("action") == "drop") & (F.col("reason") != "nothing but boilerplate"), F.col("words")).otherwise(0)).alias("dup"), F.coalesce(F.sum("cut"), F.lit(0)).alias("cut"),
        F.sum(F.when(F.col("action") == "edit", F.coalesce("strip_words", F.lit(0))).when(F.col("reason") == "nothing but boilerplate", F.col("words")).otherwise(0)).alias("boilerplate"), F.sum("words_out").alias("words_out"),
    ).withColumn("source", F.coalesce("source", F.lit("all")))


@query("SELECT source, coalesce(kind, 'none') AS kind, coalesce(reason, 'none') AS reason, count(DISTINCT path) AS files, sum(words_out) AS words_out FROM (SELECT DISTINCT source, kind, reason, path, words_out FROM plan) GROUP BY 1, 2, 3")
def plan_tally(spark, d):
    p = table(spark, d, "plan").select("source", "kind", "reason", "path", "words_out").distinct()
    return p.groupBy("source", F.coalesce("kind", F.lit("none")).alias("kind"), F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("files"), F.sum("words_out").alias("words_out"))


@query("""
    WITH c AS (SELECT DISTINCT path, cuts FROM plan WHERE cuts IS NOT NULL), e AS (SELECT path, unnest(cuts) AS c FROM c) SELECT path, c.why, c.words, c.units[1] AS from_unit, c.units[2] AS to_unit, c.counterpart.path AS counterpart FROM e
""")
def plan_cuts(spark, d):
    c = table(spark, d, "plan").filter("cuts IS NOT NULL").select("path", "cuts").distinct().select("path", F.explode("cuts").alias("c"))
    return c.select("path", "c.why", "c.words", F.element_at("c.units", 1).alias("from_unit"), F.element_at("c.units", 2).alias("to_unit"), F.col("c.counterpart.path").alias("counterpart"))


@query("""
    WITH p AS (SELECT path, any_value(action) AS action, any_value(keep_units) AS keep FROM (SELECT DISTINCT path, action, keep_units FROM plan) GROUP BY path HAVING count(*) = 1),
    u AS (SELECT f.path, action, keep, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\\s]', '', 'g') <> '') AS units FROM files f JOIN p USING (path) WHERE text <> '' AND action <> 'drop')
    SELECT path, md5(CASE WHEN action = 'keep' OR keep IS NULL THEN array_to_string(units, chr(10)) ELSE array_to_string(flatten(list_transform(keep, lambda r: units[r[1] + 1:r[2]])), chr(10)) END) AS digest FROM u
""")
def applied_plan(spark, d):
    """What a plan leaves of each file: its kept units put together again."""
    p = table(spark, d, "plan").select("path", "action", "keep_units").distinct().groupBy("path").agg(F.count("*").alias("n"), F.first("action").alias("action"), F.first("keep_units").alias("keep")).filter("n = 1 AND action <> 'drop'")
    f = table(spark, d, "files").filter("text <> ''").select("path", F.filter(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"[\s]", "") != "").alias("units"))
    kept = F.flatten(F.transform("keep", lambda r: F.slice("units", r[0] + 1, F.greatest(r[1] - r[0], F.lit(0)))))
    u = f.join(p, "path")
    return u.select("path", F.md5(F.array_join(F.when((F.col("action") == "keep") | F.col("keep").isNull(), F.col("units")).otherwise(kept), "\n")).alias("digest"))


_SENT = "WITH u AS (SELECT DISTINCT num, unnest(hashes) AS h FROM docs), k AS (SELECT h FROM u WHERE h <> 0 GROUP BY h HAVING count(*) BETWEEN 2 AND 6)"


@query(f"{_SENT}, m AS (SELECT u.num, u.h FROM u JOIN k USING (h)) SELECT a.num AS a, b.num AS b, count(*) AS shared FROM m a JOIN m b ON a.h = b.h AND a.num < b.num GROUP BY 1, 2 HAVING count(*) >= 3")
def sentence_pairs(spark, d):
    """Texts that share whole units which few texts have; by the audit's definition a unit of more than six is common."""
    u = table(spark, d, "docs").select("num", F.explode(F.array_distinct("hashes")).alias("h")).filter("h <> 0")
    m = stored(u.join(u.groupBy("h").agg(F.count("*").alias("c")).filter("c BETWEEN 2 AND 6").select("h"), "h"))
    return m.alias("x").join(m.alias("y"), F.expr("x.h = y.h AND x.num < y.num")).groupBy(F.col("x.num").alias("a"), F.col("y.num").alias("b")).agg(F.count("*").alias("shared")).filter("shared >= 3")


@query("""
    WITH u AS (SELECT DISTINCT id, unnest(hashes) AS h FROM docs), a AS (SELECT doc, max(CASE WHEN action = 'drop' THEN 0 ELSE 1 END) AS kept FROM plan GROUP BY doc)
    SELECT u.id, count(*) AS lost FROM u JOIN a ON a.doc = u.id AND a.kept = 0 WHERE h <> 0 AND h NOT IN (SELECT h FROM u JOIN a ON a.doc = u.id AND a.kept = 1) GROUP BY u.id
""")
def losses_antijoin(spark, d):
    """Units of dropped texts that no kept text has."""
    u = table(spark, d, "docs").select("id", F.explode(F.array_distinct("hashes")).alias("h")).filter("h <> 0")
    a = table(spark, d, "plan").groupBy(F.col("doc").alias("id")).agg(F.max(F.when(F.col("action") == "drop", 0).otherwise(1)).alias("kept"))
    m = stored(u.join(a, "id"))
    return m.filter("kept = 0").join(m.filter("kept = 1").select("h"), "h", "left_anti").groupBy("id").agg(F.count("*").alias("lost"))


@query("""
    WITH u AS (SELECT DISTINCT num, unnest(hashes) AS h FROM docs), c AS (SELECT num, count(*) AS n, count(*) FILTER (WHERE k > 1) AS shared FROM (SELECT num, count(*) OVER (PARTITION BY h) AS k, h FROM u WHERE h <> 0) GROUP BY num) SELECT num, n, shared, shared / n AS share FROM c
""")
def survival_share(spark, d):
    """The share of a text's units that another text has too."""
    u = table(spark, d, "docs").select("num", F.explode(F.array_distinct("hashes")).alias("h")).filter("h <> 0")
    c = u.join(u.groupBy("h").agg(F.count("*").alias("k")), "h").groupBy("num").agg(F.count("*").alias("n"), F.count_if(F.col("k") > 1).alias("shared"))
    return c.withColumn("share", F.col("shared") / F.col("n"))


_MARKED = """
    WITH u AS (SELECT num, generate_subscripts(hashes, 1) AS i, unnest(hashes) AS h, unnest(unit_words) AS w, unnest(ends) AS e FROM docs), k AS (SELECT h FROM (SELECT DISTINCT num, h FROM u WHERE h <> 0) GROUP BY h HAVING count(*) > 1), m AS (SELECT num, i, w, e FROM u WHERE h IN (SELECT h FROM k))
"""


def _marked(spark, d):
    u = table(spark, d, "docs").select("num", F.posexplode(F.arrays_zip("hashes", "unit_words", "ends")).alias("i", "x")).select("num", (F.col("i") + 1).alias("i"), F.col("x.hashes").alias("h"), F.col("x.unit_words").alias("w"), F.col("x.ends").alias("e"))
    k = stored(u.filter("h <> 0").groupBy("h").agg(F.min("num").alias("a"), F.max("num").alias("b")).filter("a < b").select("h"))
    return salted_lookup(u, k, "h", spread=F.col("num")).select("num", "i", "w", "e")


@query(f"""{_MARKED}, g AS (SELECT *, CASE WHEN e - w - lag(e) OVER (PARTITION BY num ORDER BY i) <= 300 THEN 0 ELSE 1 END AS cut FROM m), s AS (SELECT *, sum(cut) OVER (PARTITION BY num ORDER BY i) AS island FROM g)
    SELECT num, island, min(i) AS from_unit, max(i) AS to_unit, sum(w) AS words FROM s GROUP BY 1, 2""")
def unit_runs(spark, d):
    """Runs of shared units, joined over gaps of at most 300 words: gaps and islands within a text."""
    w = W.partitionBy("num").orderBy("i")
    g = _marked(spark, d).withColumn("cut", F.when(F.col("e") - F.col("w") - F.lag("e").over(w) <= 300, 0).otherwise(1))
    return g.withColumn("island", F.sum("cut").over(w)).groupBy("num", "island").agg(F.min("i").alias("from_unit"), F.max("i").alias("to_unit"), F.sum("w").alias("words"))


@query("""
    WITH u AS (SELECT num, generate_subscripts(unit_words, 1) AS i, unnest(unit_words) AS w FROM docs), r AS (SELECT num, i, sum(w) OVER (PARTITION BY num ORDER BY i ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS words, count(*) OVER (PARTITION BY num ORDER BY i ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS n FROM u) SELECT num, min(i) AS first_unit FROM r WHERE n = 12 AND words >= 400 GROUP BY num
""")
def sliding_narrative(spark, d):
    """The first window of twelve units with at least 400 words."""
    u = table(spark, d, "docs").select("num", F.posexplode("unit_words").alias("i", "w"))
    w = W.partitionBy("num").orderBy("i").rowsBetween(0, 11)
    r = u.select("num", (F.col("i") + 1).alias("i"), F.sum("w").over(w).alias("words"), F.count("*").over(w).alias("n"))
    return r.filter("n = 12 AND words >= 400").groupBy("num").agg(F.min("i").alias("first_unit"))


@query("""
    WITH l AS (SELECT path, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM (SELECT path, string_split(text, chr(10)) AS ls FROM files WHERE text IS NOT NULL)),
    a AS (SELECT path, n, regexp_extract(line, '^[Bb]y ([A-Z][a-z]+) [A-Z]', 1) AS name FROM l WHERE regexp_matches(line, '^[Bb]y [A-Z][a-z]+ [A-Z]')), t AS (SELECT path, n, line FROM l WHERE regexp_matches(line, '^[A-Z][^.!?]{2,60}\\z') AND NOT regexp_matches(line, '^[Bb]y '))
    SELECT DISTINCT t.path, t.line AS title, a.name FROM t JOIN a ON a.path = t.path AND abs(a.n - t.n) <= 6
""")
def title_near_author(spark, d):
    """Title lines with a byline within six lines: a band join within a file, by cells of six lines."""
    l = table(spark, d, "files").filter("text IS NOT NULL").select("path", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    a = l.filter(F.col("line").rlike("^[Bb]y [A-Z][a-z]+ [A-Z]")).select("path", F.col("n").alias("m"), F.regexp_extract("line", "^[Bb]y ([A-Z][a-z]+) [A-Z]", 1).alias("name"), F.explode(F.array(*[F.floor(F.col("n") / 6) + k for k in (-1, 0, 1)])).alias("cell"))
    t = l.filter(F.col("line").rlike(r"^[A-Z][^.!?]{2,60}\z") & ~F.col("line").rlike("^[Bb]y ")).withColumn("cell", F.floor(F.col("n") / 6))
    return t.join(a, ["path", "cell"]).filter(F.abs(F.col("m") - F.col("n")) <= 6).select("path", F.col("line").alias("title"), "name").distinct()


_B = _boilerplate_sql("h", "h <> 0 AND codes >= 4", 4, 0.005, 0.9)


@query(f"""
    WITH b AS ({_B}), {_UNITS},
    m AS (SELECT z.*, b.h IS NOT NULL AS known FROM z LEFT JOIN b ON b.source = z.source AND b.h = z.h AND b.zone = z.zone),
    hd AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE uw END) OVER (PARTITION BY num ORDER BY i) AS loose, max(CASE WHEN known THEN 0 ELSE uw END) OVER (PARTITION BY num ORDER BY i) AS most FROM m WHERE zone = 'head'),
    tl AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE uw END) OVER (PARTITION BY num ORDER BY i DESC) AS loose, max(CASE WHEN known THEN 0 ELSE uw END) OVER (PARTITION BY num ORDER BY i DESC) AS most FROM m WHERE zone = 'tail'),
    x AS (SELECT num, max(i) + 1 AS head_units FROM hd WHERE known AND loose <= 120 AND most <= 12 GROUP BY num), y AS (SELECT num, max(n) - min(i) AS tail_units FROM tl WHERE known AND loose <= 120 AND most <= 25 GROUP BY num),
    a AS (SELECT num, max(n) AS n, bool_and(known) AS everything FROM m GROUP BY num)
    SELECT num, CASE WHEN coalesce(head_units, 0) + coalesce(tail_units, 0) >= n AND NOT everything THEN 0 ELSE coalesce(head_units, 0) END AS head_units, CASE WHEN coalesce(head_units, 0) + coalesce(tail_units, 0) >= n AND NOT everything THEN 0 ELSE coalesce(tail_units, 0) END AS tail_units
    FROM a LEFT JOIN x USING (num) LEFT JOIN y USING (num) WHERE head_units IS NOT NULL OR tail_units IS NOT NULL
""")
def strip_edges(spark, d):
    """How many units at each edge are boilerplate: as far inward as a recognised unit has only few loose words between it and the edge.

    A text that would be left empty without being all boilerplate is left alone. Windows run within the twelve units of an edge."""
    b = stored(boilerplate_identical(spark, d)).select("source", "h", "zone", F.lit(True).alias("known"))
    m = _units(spark, d).join(b, ["source", "h", "zone"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    m = stored(m.select("num", "i", "n", "uw", "zone", "known"))
    loose = F.when(F.col("known"), 0).otherwise(F.col("uw"))

    def edge(zone: str, order, most: int):
        w = W.partitionBy("num").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
        e = m.filter(F.col("zone") == zone).withColumn("loose", F.sum(loose).over(w)).withColumn("most", F.max(loose).over(w))
        return e.filter(F.col("known") & (F.col("loose") <= 120) & (F.col("most") <= most)).groupBy("num")

    x = edge("head", F.col("i"), 12).agg((F.max("i") + 1).alias("head_units"))
    y = edge("tail", F.desc("i"), 25).agg((F.max("n") - F.min("i")).alias("tail_units"))
    a = m.groupBy("num").agg(F.max("n").alias("n"), F.bool_and("known").alias("everything"))
    j = a.join(x, "num", "left").join(y, "num", "left").filter("head_units IS NOT NULL OR tail_units IS NOT NULL").fillna(0, ["head_units", "tail_units"])
    empty = (F.col("head_units") + F.col("tail_units") >= F.col("n")) & ~F.col("everything")
    return j.select("num", F.when(empty, 0).otherwise(F.col("head_units")).alias("head_units"), F.when(empty, 0).otherwise(F.col("tail_units")).alias("tail_units"))


@query()
def greedy_decide(spark, d):
    """Keep, cut or drop by shared units, higher kinds and priorities and longer texts first."""
    from lexmill.operators.decide import decide_units

    s = table(spark, d, "sources").select(F.col("name").alias("source"), F.when(F.col("kind") == "read", 2).when(F.col("kind") == "incoming", 1).otherwise(0).alias("k"), "priority")
    own = table(spark, d, "files").filter("doc IS NOT NULL").join(F.broadcast(s), "source").groupBy(F.col("doc").alias("num")).agg(F.max(F.struct("k", "priority")).alias("o"))  # sources: 26 rows
    docs = table(spark, d, "docs").join(own, "num")
    nodes = docs.select(F.col("num").alias("id"), F.struct("o.k", "o.priority", "words", (-F.col("num")).alias("neg")).alias("rank"), "words", (F.col("o.k") == 0).alias("reference"))
    u = table(spark, d, "docs").select("num", F.explode(F.arrays_zip("hashes", "unit_words")).alias("x")).select(F.col("num").alias("id"), F.col("x.hashes").alias("unit"), F.col("x.unit_words").alias("words")).filter("unit <> 0")
    return decide_units(nodes, u, (F.col("words") - F.col("covered") < 250) & (F.col("covered") >= 0.5 * F.col("words")))


@query("""
    WITH q AS (SELECT key, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM works WHERE split = 'heldout' AND text IS NOT NULL), d AS (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    qg AS (SELECT key, i, array_to_string(w[i:i + 7], ' ') AS g FROM q, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i)), dg AS (SELECT DISTINCT array_to_string(w[i:i + 7], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i)),
    c AS (SELECT key, count(DISTINCT i + k) AS covered FROM qg JOIN dg USING (g), range(0, 8) t(k) GROUP BY key)
    SELECT q.key, len(w) AS words, coalesce(covered, 0) AS covered, coalesce(covered, 0) / len(w) AS score FROM q LEFT JOIN c USING (key) WHERE len(w) >= 8
""")
def lookup_scores(spark, d):
    """How much of each held-out work stands word for word in the documents."""
    from lexmill.operators.lookup import lookup

    return lookup(table(spark, d, "works").filter("split = 'heldout'"), table(spark, d, "documents"))[1]


@query("""
    WITH q AS (SELECT key, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM works WHERE split = 'heldout' AND text IS NOT NULL), d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    qg AS (SELECT key, i - 1 AS i, array_to_string(w[i:i + 7], ' ') AS g FROM q, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i)), dg AS (SELECT doc_id, j - 1 AS j, array_to_string(w[j:j + 7], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS j)),
    h AS (SELECT DISTINCT key, doc_id, i, j, i - j AS o FROM qg JOIN dg USING (g)), n AS (SELECT *, i - row_number() OVER (PARTITION BY key, doc_id, o ORDER BY i) AS island FROM h),
    s AS (SELECT key, doc_id, o, min(i) AS from_word, max(i) - min(i) + 8 AS words, min(j) AS doc_from FROM n GROUP BY key, doc_id, o, island)
    SELECT key, from_word, words, doc_id, doc_from, row_number() OVER (PARTITION BY key, from_word ORDER BY words DESC, doc_id, doc_from) AS rank FROM s QUALIFY rank <= 5
""")
def lookup_spans(spark, d):
    from lexmill.operators.lookup import lookup

    return lookup(table(spark, d, "works").filter("split = 'heldout'"), table(spark, d, "documents"))[0]


@query("""
    WITH r AS (SELECT key, split, words, substr(sha256('7:' || shelf || ':' || key), 1, 12) < '199999999999' OR coalesce(split = 'heldout', false) AS chosen FROM works),
    w AS (SELECT key, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM works WHERE text IS NOT NULL), g AS (SELECT DISTINCT key, array_to_string(w[i:i + 7], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i)),
    t AS (SELECT DISTINCT g FROM g JOIN r USING (key) WHERE NOT chosen), c AS (SELECT g.key, count(*) AS shared FROM g JOIN r USING (key) JOIN t ON t.g = g.g WHERE chosen GROUP BY g.key)
    SELECT r.key, coalesce(shared, 0) AS shared, CASE WHEN NOT chosen THEN 'train' WHEN coalesce(shared, 0) >= 5 THEN 'demoted' ELSE 'heldout' END AS verdict FROM r LEFT JOIN c USING (key)
""")
def heldout_demotion(spark, d):
    """The held-out choice after its check against the training works: who shares five runs or more goes back to training."""
    w = table(spark, d, "works")
    r = w.select("key", (X.lot(F.concat_ws(":", F.lit("7"), "shelf", "key"), 0.1) | F.coalesce(F.col("split") == "heldout", F.lit(False))).alias("chosen"))
    words = w.filter("text IS NOT NULL").select("key", F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)).alias("w"))
    g = stored(words.select("key", F.explode_outer(F.array_distinct(X.hashed_runs(F.col("w"), 8))).alias("g")).filter("g IS NOT NULL").join(r, "key"))
    c = g.filter("chosen").join(g.filter("NOT chosen").select("g").distinct(), "g", "left_semi").groupBy("key").agg(F.count("*").alias("shared"))
    n = F.coalesce("shared", F.lit(0))
    return r.join(c, "key", "left").select("key", n.alias("shared"), F.when(~F.col("chosen"), "train").when(n >= 5, "demoted").otherwise("heldout").alias("verdict"))


@query("""
    WITH p AS (SELECT key, unnest(string_split(text, chr(10))) AS passage FROM works WHERE split = 'heldout' AND text IS NOT NULL) SELECT DISTINCT key, doc_id FROM p JOIN documents ON contains(text, passage) WHERE len(string_split(passage, ' ')) >= 12
""")
def passage_search(spark, d):
    """Documents that hold a paragraph of a held-out work character by character: words of the passage look documents up, containment is tested on those only.

    A passage holds whole words between its first and last blank; any document that has the passage has their runs of five."""
    p = table(spark, d, "works").filter("split = 'heldout' AND text IS NOT NULL").select("key", F.explode(F.split("text", "\n")).alias("passage")).filter(F.size(F.split("passage", " ")) >= 12)
    split = lambda c: F.split(c, r"\s+")
    pw = p.select("key", "passage", split("passage").alias("w")).select("key", "passage", F.xxhash64(*[F.get("w", F.lit(k)) for k in range(1, 6)]).alias("h"))
    docs = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", "text")
    dw = docs.select("doc_id", split("text").alias("w")).select("doc_id", F.explode_outer(F.array_distinct(X.hashed_runs(F.col("w"), 5))).alias("h")).filter("h IS NOT NULL")
    hit = stored(dw.join(pw, "h").select("doc_id", "key", "passage"))
    return docs.join(hit, "doc_id").filter(F.expr("contains(text, passage)")).select("key", "doc_id").distinct()


@query()
def settled_plans(spark, d):
    """Plans with cuts settled: which units stay, which are left as remnants."""
    from lexmill.operators.settle import settled

    p = table(spark, d, "plan").filter("cuts IS NOT NULL").groupBy("path").agg(F.max_by("cuts", F.size("cuts")).alias("c"), F.first("source").alias("source"))
    f = table(spark, d, "files").filter("text <> ''").select("path", F.filter(F.split("text", "\n"), lambda x: F.regexp_replace(x, r"\s", "") != "").alias("l"))
    s = table(spark, d, "sources").select(F.col("name").alias("source"), "container")
    words = lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))
    units = F.transform("l", lambda x: F.struct(words(x).alias("words"), ((words(x) <= 12) & ~x.rlike(r"[.!?,;:]\z")).alias("heading"), x.alias("text")))
    cuts = F.transform("c", lambda c: F.struct(c["units"][0].alias("a"), c["units"][1].alias("b")))
    return settled(f.join(p, "path").join(F.broadcast(s), "source").select("path", units.alias("units"), cuts.alias("cuts"), "container"), "path")  # sources: 26 rows
