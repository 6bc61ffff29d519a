"""Consolidating pairwise matches into groups (problem 6).

Low-diameter decomposition: every vertex draws an exponential shift and starts to grow a cluster the earlier the greater it is; a vertex
joins the cluster that reaches it first, that is with the greatest shift less the distance. Clusters are contracted to super-vertices,
the edges between clusters make the graph of the next level, and the levels' assignments are composed from the last to the first. The
shifts' limit bounds the rounds of a level however long the chains are; the number of edges falls from level to level by a constant factor
on average. Once a level has few edges (BASE_EDGES, two numbers each) one task joins them.

All rounds of a level are one plan: a round joins the edges to the state of its vertices and combines what reaches each vertex. The edges are
shuffled by their first vertex once for all rounds, the state comes out of the aggregation in the same partitioning, and so a round shuffles
nothing but its messages, combined before. Only vertices reached in the round before send any: the rounds since a cluster's start are its
shift less what is left of it, so no mark is kept. Whatever a task that runs again decides among equals, a vertex bears the name of a vertex
linked to it, and so groups are right however often executors are lost.

Hot vertices are split: of one with more than HOT_EDGES edges the edges go to as many parts as needed, each linked to it, which changes no
group and leaves no task with more. Records travel as 63-bit hashes, parts of vertices as odd numbers; records of one hash are looked for first,
and another seed is taken if there are any.

Defined results: pairs with a null side and pairs of a record with itself link nothing and give no record; repeated and turned pairs are
one link; an empty table gives no rows; the group is the smallest record (byte order) of all linked; other columns are left out."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.scale import drop_stored, salted_lookup, stored, table

#: Mean of the shifts and the most that one may be: the radius of a cluster and the rounds of a level.
MEAN_SHIFT, MOST_SHIFT = 4.0, 8
#: Edges of a level that one task joins.
BASE_EDGES = 5_000
#: Edges of a vertex before it is split.
HOT_EDGES = 50_000
LINKS = ("same work", "contained", "shares a work")


def _shift(v: Column, level: int) -> Column:
    unit = lambda name: (F.pmod(F.xxhash64(v, F.lit(level), F.lit(name)), F.lit(1 << 40)).cast("double") + 1) / float((1 << 40) + 1)
    drawn = -F.log(unit("shift")) * MEAN_SHIFT
    # those beyond the limit start in its last round, in an order of their own
    return F.when(drawn < MOST_SHIFT, drawn).otherwise(MOST_SHIFT - unit("tie"))


def _grow(edges: DataFrame, level: int) -> DataFrame:
    """v, c: every vertex of the stored edges (u, v) with the vertex whose cluster reached it first."""
    pair = lambda x, y: F.struct(F.col(x).alias("u"), F.col(y).alias("v"))
    both = edges.select(F.explode(F.array(pair("u", "v"), pair("v", "u"))).alias("e")).select("e.u", "e.v")

    def best(rows: DataFrame, sends: Column) -> DataFrame:
        """The greatest key that reaches each vertex: what stands at u already, told once for each edge, and what u sends along it."""
        told = lambda v, key: F.struct(F.col(v).alias("v"), key.alias("key"), F.col("c"))
        each = F.array(told("u", F.col("key")), F.when(sends & (F.col("key") > 1), told("v", F.col("key") - 1)))
        return rows.select(F.explode(each).alias("m")).filter("m IS NOT NULL").select("m.*").groupBy("v").agg(F.max("key").alias("key"), F.max_by("c", "key").alias("c"))

    state = best(both.select("u", "v", _shift(F.col("u"), level).alias("key"), F.col("u").alias("c")), F.lit(True))
    for hops in range(1, MOST_SHIFT - 1):
        here = state.select(F.col("v").alias("u"), "key", "c", (F.round(_shift(F.col("c"), level) - F.col("key")) == hops).alias("fresh"))
        state = best(both.join(here.hint("shuffle_hash"), "u"), F.col("fresh"))
    return stored(state.select("v", "c"))


def _split(edges: DataFrame, degrees: DataFrame, level: int, most: int) -> DataFrame:
    """The edges with vertices of more than `most` edges split into parts that are linked to them."""
    hot = stored(degrees.filter(F.col("n") > most).select("u", F.ceil(F.col("n") / most).cast("int").alias("parts")))
    part = lambda v, other, parts: F.when(parts.isNull(), v).otherwise(F.xxhash64(v, F.pmod(F.xxhash64(other), parts), F.lit(level)).bitwiseOR(F.lit(1)))
    one = salted_lookup(edges, hot, "u", "left", spread=F.col("v")).withColumnRenamed("parts", "pu")
    two = salted_lookup(one, hot.withColumnRenamed("u", "v"), "v", "left", spread=F.col("u")).withColumnRenamed("parts", "pv")
    rows = two.select("u", "v", part(F.col("u"), F.col("v"), F.col("pu")).alias("x"), part(F.col("v"), F.col("u"), F.col("pv")).alias("y"))
    links = rows.filter("u <> x").select("u", F.col("x").alias("v")).union(rows.filter("v <> y").select("v", "y")).distinct()
    return stored(rows.select("x", "y").union(links).select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())


def _joined(edges: DataFrame) -> DataFrame:
    """v, c of few edges, by one task."""

    def run(batches):
        parent: dict[int, int] = {}

        def find(x):
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        yield pa.RecordBatch.from_arrays([pa.array([*parent], pa.int64()), pa.array([find(x) for x in [*parent]], pa.int64())], names=["v", "c"])

    return stored(edges.select("u", "v").coalesce(1).mapInArrow(run, "v long, c long"))


def components(edges: DataFrame, base: int = BASE_EDGES, hot: int = HOT_EDGES) -> DataFrame:
    """v, c: every vertex of edges (u, v of bigint, even numbers, neither null) with one vertex of its component, the same for all of it; there may be
    vertices of odd numbers besides."""
    edges = stored(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    levels: list[DataFrame] = []
    while True:
        degrees = edges.select(F.explode(F.array("u", "v")).alias("u")).groupBy("u").agg(F.count("*").alias("n"))
        ends, most = degrees.agg(F.sum("n"), F.max("n")).first()
        if (ends or 0) <= 2 * base:
            break
        if most > hot:
            split = _split(edges, degrees, len(levels), hot)
            drop_stored(edges)
            edges = split
        own = _grow(edges, len(levels))
        levels.append(own)
        half = salted_lookup(edges, own.select(F.col("v").alias("u"), F.col("c").alias("cu")), "u", spread=F.col("v"))
        full = salted_lookup(half, own.select("v", F.col("c").alias("cv")), "v", spread=F.col("u"))
        between = stored(full.filter("cu <> cv").select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct())
        drop_stored(edges)
        edges = between
    found = _joined(edges)
    drop_stored(edges)
    while levels:
        own = levels.pop()
        above = found.select(F.col("v").alias("c"), F.col("c").alias("top"))
        found = stored(salted_lookup(own, above, "c", "left", spread=F.col("v")).select("v", F.coalesce("top", "c").alias("c")))
    return found


def linked_groups(pairs: DataFrame, a: str = "a", b: str = "b", record: str = "record", group: str = "group", **limits) -> DataFrame:
    """Each record of the linking pairs with the smallest record of its group."""
    links = stored(pairs.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b"))
    seed = 0
    while True:
        number = lambda c: F.shiftleft(F.xxhash64(F.lit(seed), c), 1)  # noqa: B023, E731
        records = stored(links.select(F.explode(F.array("a", "b")).alias("record")).distinct().select("record", number(F.col("record")).alias("v")))
        if records.groupBy("v").count().filter("count > 1").isEmpty():
            break
        drop_stored(records)
        seed += 1
    found = components(links.select(number(F.col("a")).alias("u"), number(F.col("b")).alias("v")), **limits)
    named = stored(records.join(found, "v").select("record", "c"))
    names = stored(named.groupBy("c").agg(F.min("record").alias("name")))
    return salted_lookup(named, names, "c", spread=F.col("record")).select(F.col("record").alias(record), F.col("name").alias(group))


def p6_found(spark, d):
    pairs = table(spark, d, "pairs").filter(F.col("relation").isin(*LINKS))
    return linked_groups(pairs.select("a.path", "b.path").toDF("a", "b"), record="path", group="group_path")


def p6_sizes(spark, d):
    """Groups by their number of records."""
    return p6_found(spark, d).groupBy("group_path").agg(F.count("*").alias("records")).groupBy("records").agg(F.count("*").alias("groups"))


QUERIES = {"p6_found": p6_found, "p6_sizes": p6_sizes}
_GROUPS = """
    WITH RECURSIVE l AS (SELECT a.path AS a, b.path AS b FROM pairs WHERE relation IN ('same work', 'contained', 'shares a work') AND a.path <> b.path),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r(path, seen) AS (SELECT a, a FROM e UNION SELECT r.path, e.b FROM r JOIN e ON r.seen = e.a),
    g AS (SELECT path, min(seen) AS group_path FROM r GROUP BY path)
"""
SQL = {
    "p6_found": f"{_GROUPS} SELECT * FROM g",
    "p6_sizes": f"{_GROUPS} SELECT records, count(*) AS groups FROM (SELECT count(*) AS records FROM g GROUP BY group_path) GROUP BY records",
}
