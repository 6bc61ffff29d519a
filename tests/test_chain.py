"""The chain from matched texts to plan records: layered decisions against walking the texts one after another, and records that add up."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import chain
from lexmill.operators.settle import settle
from lexmill.plans import catalog

DATA = "/root/testdata/sf0.001"
BLOCK = "array<struct<`from`:int,`to`:int,spared:array<array<int>>>>"


def one_by_one(nodes, edges, units):
    """Texts in order of rank; each looks at the living texts above it."""
    fate, out = {}, {}
    for num, pos, container, head, tail, reference in sorted(nodes, key=lambda n: n[1]):
        if reference:
            continue
        mine = sorted((e for e in edges if e[0] == num and fate.get(e[1]) == "keep"), key=lambda e: e[2])
        by = next((e for e in mine if e[3]), None)
        if by:
            fate[num], out[num] = "drop", ("drop", by[4], by[1], [], 0)
            continue
        cut = {}
        for low, high, above, drops, reason, chosen, why in mine:
            for a, b, spared in chosen or ():
                for u in range(a, b):
                    if not any(x <= u < y for x, y in spared):
                        cut.setdefault(u, (why, high))
        n = len(units[num])
        ranges = []
        for u in sorted(cut):
            if ranges and ranges[-1][1] == u:
                ranges[-1] = (ranges[-1][0], u + 1)
            else:
                ranges.append((u, u + 1))
        kept, _ = settle(units[num], ranges, container) if ranges else ([(0, n)] if n else [], [])
        left = [u for a, b in kept for u in range(a, b) if head <= u < n - tail]
        words = sum(units[num][u][0] for u in left)
        first = cut[min(cut)] if cut else None
        if words:
            why = sorted({w for w, _ in cut.values()} | ({"boilerplate"} if head or tail else set()))
            fate[num], out[num] = "keep", ("keep", "; ".join(why) or None, first and first[1], left, words)
        else:
            fate[num], out[num] = "drop", ("drop", "nothing left after cuts" if cut else "nothing but boilerplate", first and first[1], [], 0)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_decisions_equal_walking_the_texts(spark, seed):
    rng = random.Random(seed)
    nodes, units, edges = [], {}, []
    places = rng.sample(range(1000), 40)
    for num in range(40):
        n = rng.randrange(1, 9)
        units[num] = [(rng.choice((0, 3, 90, 1200)), rng.random() < 0.3, f"unit {u} of Harbour") for u in range(n)]
        nodes.append((num, places[num], rng.random() < 0.3, rng.choice((0, 0, 0, 1)), rng.choice((0, 0, 0, 1)), rng.random() < 0.1))
    of = {n[0]: n for n in nodes}
    for _ in range(130):
        a, b = rng.sample(range(40), 2)
        if of[a][5] or of[b][5]:
            continue
        low, high = (a, b) if of[a][1] > of[b][1] else (b, a)
        if any(e[:2] == (low, high) for e in edges):
            continue
        blocks = []
        for _ in range(rng.randrange(3)):
            x = rng.randrange(len(units[low]))
            y = rng.randrange(x, len(units[low])) + 1
            blocks.append((x, y, [(x, x + 1)] if rng.random() < 0.3 else []))
        edges.append((low, high, of[high][1], rng.random() < 0.25, rng.choice(("same work", "contained in a document that outranks it")), rng.choice((blocks, blocks, None)), rng.choice(("shares a work", "contains"))))
    n = spark.createDataFrame(nodes, "num long, pos int, container boolean, head int, tail int, reference boolean")
    e = spark.createDataFrame([(*x[:5], x[5] and [(a, b, [list(y) for y in s]) for a, b, s in x[5]] or x[5], x[6]) for x in edges], f"low long, high long, pos int, drops boolean, reason string, chosen {BLOCK}, why string")
    u = spark.createDataFrame([(k, v) for k, v in units.items()], "num long, units array<struct<words:int,heading:boolean,line:string>>")
    got = {r.num: (r.fate, r.reason, r.counterpart, [x for a, b in r.keep for x in range(a, b)], r.words_out) for r in chain.decide_chain(n, e, u).collect()}
    want = one_by_one(nodes, edges, units)
    assert got == want and {x[0] for x in want.values()} == {"keep", "drop"}


def test_blocks(spark):
    """A passage between own words: found from both sides, with what is loose, an edge that joins and a run that is spared."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    shared = [words("s", 60), words("t", 60), words("u", 60)]
    units = [words("a", 400), ["s0", "s1", *words("x", 1)], *shared[:2], words("own", 120), shared[2], words("z", 500)]
    flat = [w for u in units for w in u]
    other = [w for u in shared for w in u]
    ids = {}
    run = lambda ws: np.array([ids.setdefault(tuple(ws[i : i + chain.SIZE]), len(ids)) for i in range(len(ws) - chain.SIZE + 1)])
    a, b = run(flat), run(other)
    sizes = np.array([len(u) for u in units])
    blocks, loose = chain.blocks_of(sizes, sizes, a, np.intersect1d(a, b))
    assert [(k["from"], k["to"], k["words"], k["spared"]) for k in blocks] == [(2, 6, 300, [[4, 5]])] and loose == 500
    assert blocks[0]["held"] == 113 + 53 and blocks[0]["purity"] == 0.6
    assert chain.blocks_of(sizes, sizes, a, np.zeros(0, np.int64)) == ([], int(sizes.sum()))


def test_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "* * *\n\n~"), (4, "One two\n\n  \nthree’s é"), (None, "x")], "num long, text string").withColumn("lines", F.lit(1))
    rows = {r.num: r for r in chain.encode(df).collect()}
    assert rows.keys() == {2, 3, 4} and rows[2].lines == [] and rows[3].unit_words == [0, 0] and rows[3].hashes == [0, 0]
    assert rows[4].unit_codes == [2, 2] and rows[4].unit_words == [2, 2] and rows[4].runs == []
    pairs = spark.createDataFrame([(2, 3), (3, 4), (4, None), (4, 99), (4, 4)], "x long, y long")
    assert chain.compare(pairs, chain.encode(df)).count() == 0 and chain.compare(pairs.limit(0), chain.encode(df.limit(0))).count() == 0
    nodes = spark.createDataFrame([], "num long, pos int, container boolean, head int, tail int, reference boolean")
    edges = spark.createDataFrame([], f"low long, high long, pos int, drops boolean, reason string, chosen {BLOCK}, why string")
    units = spark.createDataFrame([], "num long, units array<struct<words:int,heading:boolean,line:string>>")
    assert chain.decide_chain(nodes, edges, units).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_records_add_up(spark):
    q = catalog.queries()
    plan = q["chain_plan"](spark, DATA)
    rows = plan.collect()
    files = {r.path for r in spark.read.parquet(f"{DATA}/files.parquet").filter("doc IS NOT NULL").join(spark.read.parquet(f"{DATA}/sources.parquet").filter("kind <> 'reference'").withColumnRenamed("name", "source").select("source"), "source").collect()}
    assert {r.path for r in rows} == files and len(rows) >= len(files)
    assert {r.action for r in rows} == {"keep", "edit", "drop"}
    assert all((r.words_out == 0) == (r.action == "drop") and (r.action != "edit" or r.keep_units) for r in rows)
    left = q["chain_applied"](spark, DATA).collect()
    assert len(left) == sum(r.action != "drop" for r in rows) and all(r.counted == r.promised for r in left)
