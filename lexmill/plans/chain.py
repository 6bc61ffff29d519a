"""The chain from matched texts to plan records over the tables of the workbench. Candidates are the pairs of files that the table pairs lists; units
and runs of any number of texts count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators import chain
from lexmill.plans.catalog import query
from lexmill.plans.dedup import equal_bodies, strip_edges
from lexmill.scale import salted_lookup, stored, table

L = chain.LIMITS
_B, _G = chain.BLANK, chain.GLUE.replace("'", "''")


def _texts(spark, d) -> DataFrame:
    """num and text of each text of the index: what stands under its smallest path."""
    f = table(spark, d, "files").filter("doc IS NOT NULL AND text IS NOT NULL")
    return f.groupBy(F.col("doc").alias("num")).agg(F.min(F.struct("path", "text")).alias("t")).select("num", "t.text")


def _pairs(spark, d) -> DataFrame:
    """x < y of the texts of every pair of files that is listed."""
    f = stored(table(spark, d, "files").filter("doc IS NOT NULL").groupBy("path").agg(F.min("doc").alias("doc")))
    p = table(spark, d, "pairs").select(F.col("a.path").alias("p"), F.col("b.path").alias("q")).filter("p IS NOT NULL AND q IS NOT NULL").distinct()
    p = salted_lookup(p, f.select(F.col("path").alias("p"), F.col("doc").alias("x")), "p", spread=F.col("q"))
    p = salted_lookup(p, f.select(F.col("path").alias("q"), F.col("doc").alias("y")), "q", spread=F.col("p"))
    return p.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x <> y").distinct()


def _samples(spark, d) -> DataFrame:
    """num, sample, and those of it that twenty texts or more have."""
    s = table(spark, d, "docs").select("num", F.array_distinct("sample").alias("sample"))
    each = s.select("num", F.explode("sample").alias("h"))
    many = stored(each.groupBy("h").agg(F.count("*").alias("c")).filter("c >= 20").select("h"))
    common = salted_lookup(each, many, "h", spread=F.col("num")).groupBy("num").agg(F.collect_list("h").alias("common"))
    return s.join(common, "num", "left").withColumn("common", F.coalesce("common", F.array().cast("array<long>")))


def _verdicts(spark, d) -> DataFrame:
    return stored(chain.compare(_pairs(spark, d), stored(chain.encode(_texts(spark, d))), _samples(spark, d)))


_UNITS = f"""
    t AS (SELECT doc AS num, arg_min(text, path) AS text FROM files WHERE doc IS NOT NULL AND text IS NOT NULL GROUP BY doc),
    l AS (SELECT num, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{_B}', '', 'g') <> '') AS lines FROM t),
    i AS (SELECT num, generate_subscripts(lines, 1) - 1 AS u, unnest(lines) AS line FROM l),
    v AS (SELECT num, u, CASE WHEN len(t) > 0 THEN len(list_filter(regexp_split_to_array(line, '{_B}+'), lambda x: x <> '')) ELSE 0 END AS words, t FROM (SELECT *, regexp_extract_all(regexp_replace(lower(line), '{_G}', '', 'g'), '[\\p{{L}}\\p{{N}}]+') AS t FROM i))
"""
_TOLD = f"""WITH {_UNITS},
    w AS (SELECT num, u, words, len(t) AS n, coalesce(sum(len(t)) OVER b, 0) AS c0, coalesce(sum(words) OVER b, 0) AS w0 FROM v WINDOW b AS (PARTITION BY num ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    k AS (SELECT num, flatten(list(t ORDER BY u)) AS w, sum(words) AS words FROM v GROUP BY num), r AS (SELECT num, pos, array_to_string(w[pos + 1:pos + {chain.SIZE}], ' ') AS h FROM k, LATERAL (SELECT unnest(range(0, len(w) - {chain.SIZE} + 1)) AS pos)),
    f AS (SELECT path, min(doc) AS doc FROM files WHERE doc IS NOT NULL GROUP BY path),
    p AS (SELECT DISTINCT least(x.doc, y.doc) AS x, greatest(x.doc, y.doc) AS y FROM pairs JOIN f x ON x.path = pairs.a.path JOIN f y ON y.path = pairs.b.path WHERE x.doc <> y.doc AND x.doc IN (SELECT num FROM t) AND y.doc IN (SELECT num FROM t)),
    d AS (SELECT DISTINCT num, h FROM r), s AS (SELECT x, y, a.h FROM p JOIN d a ON a.num = x JOIN d b ON b.num = y AND a.h = b.h),
    hit AS (SELECT x, y, r.num, pos, r.h FROM s JOIN r ON r.h = s.h AND (r.num = x OR r.num = y)), cov AS (SELECT DISTINCT x, y, num, pos + o AS c FROM hit, range(0, {chain.SIZE}) q(o)),
    uc AS (SELECT x, y, w.num, u, count(*) AS cover, any_value(n) AS n, any_value(words) AS words, any_value(w0) AS w0 FROM cov JOIN w ON w.num = cov.num AND c >= c0 AND c < c0 + n GROUP BY x, y, w.num, u),
    g AS (SELECT *, CASE WHEN w0 - lag(w0 + words) OVER o <= {L["gap"]} THEN 0 ELSE 1 END AS cut FROM uc WHERE cover >= {L["unit"]} * n WINDOW o AS (PARTITION BY x, y, num ORDER BY u)),
    e AS (SELECT x, y, num, sum(cut) OVER (PARTITION BY x, y, num ORDER BY u) AS blk, u FROM g), c AS (SELECT x, y, num, min(u) AS a, max(u) AS b FROM e GROUP BY x, y, num, blk),
    j AS (SELECT x, y, num, u FROM uc WHERE words BETWEEN 1 AND {L["edge_words"]} AND cover >= {L["edge"]} * greatest(n, 1)),
    q AS (SELECT c.x, c.y, c.num, c.a - CASE WHEN m.u IS NULL THEN 0 ELSE 1 END AS a, c.b + CASE WHEN o.u IS NULL THEN 0 ELSE 1 END AS b FROM c LEFT JOIN j m ON m.x = c.x AND m.y = c.y AND m.num = c.num AND m.u = c.a - 1 LEFT JOIN j o ON o.x = c.x AND o.y = c.y AND o.num = c.num AND o.u = c.b + 1),
    z AS (SELECT q.x, q.y, q.num, q.a, q.b, min(c0) AS c0, max(c0 + n) AS c1, sum(w.words) AS words FROM q JOIN w ON w.num = q.num AND w.u BETWEEN q.a AND q.b GROUP BY 1, 2, 3, 4, 5),
    blocks AS (SELECT z.*, (SELECT count(DISTINCT h) FROM hit WHERE hit.x = z.x AND hit.y = z.y AND hit.num = z.num AND pos >= z.c0 AND pos <= z.c1 - {chain.SIZE}) AS held,
      round((SELECT count(*) FROM cov WHERE cov.x = z.x AND cov.y = z.y AND cov.num = z.num AND cov.c >= z.c0 AND cov.c < z.c1) / greatest(1, z.c1 - z.c0), 4) AS purity FROM z),
    smp AS (SELECT num, list_distinct(sample) AS sample FROM docs), cm AS (SELECT coalesce(list(h), []) AS l FROM (SELECT h FROM (SELECT unnest(sample) AS h FROM smp) GROUP BY h HAVING count(*) >= 20)),
    sc AS (SELECT num, sample, list_intersect(sample, l) AS common, CASE WHEN len(sample) > 0 THEN len(list_intersect(sample, l)) / len(sample) ELSE 0 END AS share FROM smp, cm),
    size AS (SELECT num, count(*) AS runs FROM d GROUP BY num),
    n AS (SELECT s.x, s.y, count(*) AS shared, any_value(CASE WHEN len(list_intersect(a.sample, b.sample)) > 0 THEN len(list_intersect(list_intersect(a.sample, b.sample), a.common)) / len(list_intersect(a.sample, b.sample)) ELSE 0 END) AS discount,
      any_value(sa.runs * (1 - coalesce(a.share, 0))) AS size_x, any_value(sb.runs * (1 - coalesce(b.share, 0))) AS size_y FROM s LEFT JOIN sc a ON a.num = s.x LEFT JOIN sc b ON b.num = s.y JOIN size sa ON sa.num = s.x JOIN size sb ON sb.num = s.y GROUP BY s.x, s.y),
    ok AS (SELECT *, floor(shared * (1 - discount)) + {chain.SIZE - 1} AS matched_words, least(1, shared * (1 - discount) / size_x) AS of_x, least(1, shared * (1 - discount) / size_y) AS of_y FROM n WHERE size_x >= 1 AND size_y >= 1 AND floor(shared * (1 - discount)) + {chain.SIZE - 1} >= {L["match_words"]}),
    big AS (SELECT x, y, num, sum(held) AS held, sum(words * purity) AS cover FROM blocks WHERE words >= {L["big_words"]} AND purity >= {L["big_purity"]} GROUP BY 1, 2, 3), best AS (SELECT x, y, num, max(held) AS held FROM blocks GROUP BY 1, 2, 3),
    verdict AS (SELECT ok.*, (of_x >= {L["same"]} AND of_y >= {L["same"]}) OR (coalesce(bx.cover, 0) / greatest(1, kx.words) >= {L["same_cover"]} AND coalesce(b_y.cover, 0) / greatest(1, ky.words) >= {L["same_cover"]}) AS same,
      coalesce(hx.held, 0) * (1 - discount) >= {L["contained"]} * size_y OR coalesce(hy.held, 0) * (1 - discount) >= {L["contained"]} * size_x AS contained, coalesce(least(bx.held, b_y.held) / shared, 0) * CASE WHEN bx.held IS NULL OR b_y.held IS NULL THEN 0 ELSE 1 END AS inside
      FROM ok JOIN k kx ON kx.num = ok.x JOIN k ky ON ky.num = ok.y LEFT JOIN big bx ON bx.x = ok.x AND bx.y = ok.y AND bx.num = ok.x LEFT JOIN big b_y ON b_y.x = ok.x AND b_y.y = ok.y AND b_y.num = ok.y LEFT JOIN best hx ON hx.x = ok.x AND hx.y = ok.y AND hx.num = ok.x LEFT JOIN best hy ON hy.x = ok.x AND hy.y = ok.y AND hy.num = ok.y),
    told AS (SELECT *, CASE WHEN same THEN 'same work' WHEN contained THEN 'contained' WHEN inside >= {L["clean"]} THEN 'shares a work' ELSE 'partial' END AS relation FROM verdict WHERE same OR contained OR inside >= {L["container_clean"]} OR greatest(of_x, of_y) >= {L["listed"]} OR matched_words >= {L["listed_words"]})
"""


@query("SELECT num, codes, ends, unit_words FROM docs WHERE num IN (SELECT doc FROM files WHERE text IS NOT NULL)")
def encoded_texts(spark, d):
    """Texts encoded anew: words for comparison, their running count by units, words by white space of units; they must be what the index holds."""
    e = chain.encode(_texts(spark, d)).join(table(spark, d, "docs").select("num"), "num", "left_semi")
    add = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    ends = F.transform("unit_codes", lambda _, i: add(F.slice("unit_codes", F.lit(1), i + 1)))
    return e.select("num", add("unit_codes").alias("codes"), ends.alias("ends"), "unit_words")


@query("SELECT num, unit, min(num) OVER (PARTITION BY h) AS same_as FROM (SELECT num, generate_subscripts(hashes, 1) AS unit, unnest(hashes) AS h FROM docs WHERE num IN (SELECT doc FROM files WHERE text IS NOT NULL)) WHERE h <> 0")
def unit_classes(spark, d):
    """Units with the first text that has the same words: the hashes worked out from the texts tell the same units apart as the index's."""
    e = chain.encode(_texts(spark, d)).join(table(spark, d, "docs").select("num"), "num", "left_semi")
    u = stored(e.select("num", F.posexplode("hashes").alias("i", "h")).filter("h <> 0").select("num", (F.col("i") + 1).alias("unit"), "h"))
    first = stored(u.groupBy("h").agg(F.min("num").alias("same_as")))
    return salted_lookup(u, first, "h", spread=F.col("num")).select("num", "unit", "same_as")


@query(f"{_TOLD} SELECT x, y, num, CAST(a AS INTEGER) AS from_unit, CAST(b + 1 AS INTEGER) AS to_unit, words, held, purity FROM blocks JOIN told USING (x, y)")
def chain_blocks(spark, d):
    """Blocks of both sides of every told pair."""
    v = _verdicts(spark, d)
    side = lambda num, s: F.struct(F.col(num).alias("num"), F.col(f"{s}.blocks").alias("blocks"))
    b = v.select("x", "y", F.explode(F.array(side("x", "a"), side("y", "b"))).alias("s")).select("x", "y", "s.num", F.explode("s.blocks").alias("k"))
    return b.select("x", "y", "num", F.col("k.from").alias("from_unit"), F.col("k.to").alias("to_unit"), "k.words", "k.held", "k.purity")


@query(f"{_TOLD} SELECT x, y, matched_words, round(of_x, 4) AS of_x, round(of_y, 4) AS of_y, round(discount, 4) AS discount, relation FROM told")
def chain_verdicts(spark, d):
    """What every listed pair of texts is: the same work, one contained in the other, sharing a work, or sharing a part."""
    return _verdicts(spark, d).select("x", "y", "matched_words", F.col("a.of").alias("of_x"), F.col("b.of").alias("of_y"), "discount", "relation")


def _plan(spark, d) -> DataFrame:
    s = table(spark, d, "sources").select(F.col("name").alias("source"), "kind", "priority", "rough", "container")
    rank = F.when(F.col("kind") == "read", 0).when(F.col("kind") == "incoming", 1).otherwise(2)
    f = table(spark, d, "files").filter("doc IS NOT NULL AND text IS NOT NULL").select("source", "path", F.col("doc").alias("num")).join(F.broadcast(s), "source")  # sources: 26 rows
    f = f.withColumn("rank", F.struct(rank.alias("kind_rank"), (-F.col("priority")).alias("less"), "rough", (~F.col("container")).alias("open"), "path"))
    best = stored(f.groupBy("num").agg(F.min("rank").alias("best"), F.min(F.struct("rank", "kind", "rough", "container")).alias("b")))
    files = salted_lookup(f, best.select("num", "best"), "num", spread=F.col("path")).select("source", "path", "num", "kind", (F.col("rank") == F.col("best")).alias("first"))
    enc = stored(chain.encode(_texts(spark, d)))
    leaders = stored(equal_bodies(spark, d))
    edges = stored(strip_edges(spark, d))
    words = F.aggregate("unit_words", F.lit(0), lambda a, x: a + x)
    n = enc.select("num", words.alias("words")).join(best, "num").join(edges, "num", "left")
    pos = F.struct("b.rank.kind_rank", "b.rank.less", "b.rank.rough", "b.rank.open", (-F.col("words")).alias("short"), "num")
    nodes = n.select("num", pos.alias("pos"), "b.rough", "b.container", (F.col("b.kind") == "reference").alias("reference"), (F.col("b.kind") == "read").alias("fixed"), F.coalesce("head_units", F.lit(0)).alias("head"), F.coalesce("tail_units", F.lit(0)).alias("tail"))
    followers = leaders.filter("num <> leader").select("num")
    nodes = stored(nodes.join(followers, "num", "left_anti"))
    flags = table(spark, d, "docs").select("num", "flags")
    units = enc.join(flags, "num", "left").select("num", F.transform(F.arrays_zip("unit_words", "flags", "lines"), lambda u: F.struct(u["unit_words"].alias("words"), (F.coalesce(u["flags"], F.lit(0)).bitwiseAND(2) > 0).alias("heading"), u["lines"].alias("line"))).alias("units"))
    units = stored(units)
    told = stored(chain.compare(_pairs(spark, d).join(nodes.select(F.col("num").alias("x")), "x", "left_semi").join(nodes.select(F.col("num").alias("y")), "y", "left_semi"), enc, _samples(spark, d)))
    outcomes = stored(chain.decide_chain(nodes, stored(chain.edges_of(told, nodes)), units))
    return stored(chain.records(files, leaders, outcomes, units))


@query()
def chain_plan(spark, d):
    """A plan record for every file: kept, edited or dropped, why, in whose favour, and what is left of it."""
    return _plan(spark, d)


@query()
def chain_applied(spark, d):
    """What the plan leaves of each file, with the words its record promises."""
    plan = _plan(spark, d)
    f = table(spark, d, "files").filter("doc IS NOT NULL AND text IS NOT NULL").select("path", F.filter(F.split("text", "\n"), lambda x: F.regexp_replace(x, chain.BLANK, "") != "").alias("lines"))
    left = chain.applied(f, plan)
    counts = F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")), chain.ws_count)
    return left.select("path", F.md5("text").alias("digest"), F.aggregate(counts, F.lit(0), lambda a, x: a + x).alias("counted")).join(plan.select("path", F.col("words_out").alias("promised")), "path")


@query()
def chain_report(spark, d):
    """Files and words of each source by action and reason."""
    return _plan(spark, d).groupBy("source", "action", F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("files"), F.sum("words").alias("words"), F.sum("words_out").alias("words_out"))
