"""The chain from matched texts to plan records: encode texts, compare pairs, decide in layers, settle what is cut, write records.

Every step is a table: encoded texts, verdicts on pairs with the blocks each side has in common with the other, outcomes of texts, records of
files. Pairs are compared one row at a time, so neither a text of many pairs nor a passage of many texts meets in a group; decisions are made
for whole layers of texts by joins and sums (see decide_chain)."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators.settle import settle
from lexmill.scale import drop_stored, salted_lookup, stored

SIZE = 8
#: Thresholds of matching. Shares of words or runs, numbers of words.
LIMITS = {
    "match_words": 100, "same": 0.75, "same_cover": 0.85, "contained": 0.8, "unit": 0.75, "gap": 300, "spare": 100, "edge": 0.5, "edge_words": 30, "big_words": 800, "big_purity": 0.8,
    "clean": 0.9, "container_clean": 0.5, "most_of": 0.5, "unique": 250, "rough_unique": 1500, "listed": 0.2, "listed_words": 500,
}
#: What is dropped from words, as the index does it, and white space that a unit may consist of.
GLUE = "['’]"
BLANK = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}\x{0b}]"


def ws_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, f"{BLANK}+"), lambda w: w != ""))


def encode(texts: DataFrame, num: str = "num", text: str = "text", size: int = SIZE) -> DataFrame:
    """num, lines (the non-blank ones: units), unit_words (by white space; 0 for units of signs alone), unit_codes (words for comparison), hashes (of each unit's words, 0 for
    none), runs (hashes of all runs of `size` words over the whole text). Words for comparison are runs of letters and digits in lower case,
    apostrophes dropped; all else only separates them. Null texts are left out; texts without a word have no runs."""
    lines = texts.filter(F.col(text).isNotNull() & F.col(num).isNotNull()).select(F.col(num).alias("num"), F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, BLANK, "") != "").alias("lines"))
    tokens = F.transform("lines", lambda x: F.regexp_extract_all(F.regexp_replace(F.lower(x), GLUE, ""), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    split = lines.select("num", "lines", tokens.alias("t"), F.transform("lines", ws_count).alias("ws"))
    flat = split.select("*", F.zip_with("ws", "t", lambda n, t: F.when(F.size(t) > 0, n).otherwise(0)).alias("unit_words"), F.flatten("t").alias("w"), F.transform("t", lambda x: F.size(x)).alias("unit_codes"), F.transform("t", lambda x: F.when(F.size(x) > 0, F.xxhash64(x)).otherwise(F.lit(0).cast("long"))).alias("hashes"))
    return flat.select("num", "lines", "unit_words", "unit_codes", "hashes", X.hashed_runs(F.col("w"), size).alias("runs"))


def blocks_of(codes: np.ndarray, words: np.ndarray, runs: np.ndarray, shared: np.ndarray, size: int = SIZE) -> tuple[list[dict], int]:
    """(blocks, loose): where a text's units stand in another, given the runs that both have.

    A unit is matched if enough of its words lie in shared runs. Matched units are one block over gaps of few words; a short unit next to a block
    joins it if half of it is matched. A block tells its half-open range of units, its words, how many distinct shared runs it holds, the share
    of its words that are matched (purity), and the ranges of unmatched units within it that are long enough to be spared. loose: the most words
    in a row that no block has."""
    upto = np.concatenate([[0], np.cumsum(words)])
    ends = np.cumsum(codes)
    starts = ends - codes
    hit = np.isin(runs, shared)
    at = np.flatnonzero(hit)
    if not len(at):
        return [], int(upto[-1])
    change = np.zeros(int(ends[-1]) + 1, np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    cover = inside[ends] - inside[starts]
    matched = (codes > 0) & (cover >= LIMITS["unit"] * codes)
    joins = (words > 0) & (words <= LIMITS["edge_words"]) & (cover >= LIMITS["edge"] * np.maximum(codes, 1))
    units = np.flatnonzero(matched)
    if not len(units):
        return [], int(upto[-1])
    apart = np.flatnonzero(upto[units[1:]] - upto[units[:-1] + 1] > LIMITS["gap"])
    out, loose, behind = [], 0, 0
    for a, b in zip(units[np.append(0, apart + 1)].tolist(), units[np.append(apart, len(units) - 1)].tolist(), strict=True):
        a -= bool(a > behind and joins[a - 1])
        b += bool(b + 1 < len(codes) and joins[b + 1])
        loose, behind = max(loose, int(upto[a] - upto[behind])), b + 1
        first, last = int(starts[a]), int(ends[b])
        held = at[(at >= first) & (at <= last - size)]
        # unmatched units between matched ones of the block, without units that have no words at their edges
        spared, own = [], [u for u in range(a, b + 1) if matched[u]]
        for x, y in zip([a - 1, *own], [*own, b + 1], strict=True):
            with_words = [u for u in range(x + 1, y) if codes[u] > 0]
            if with_words and with_words[0] > a and int(upto[y] - upto[with_words[0]]) >= LIMITS["spare"] and y <= b + 1:
                spared.append([with_words[0], with_words[-1] + 1])
        out.append({"from": a, "to": b + 1, "words": int(upto[b + 1] - upto[a]), "held": len(np.unique(runs[held])), "purity": round(int(inside[last] - inside[first]) / max(1, last - first), 4), "spared": spared})
    return out, max(loose, int(upto[-1] - upto[behind]))


def relate(a: dict, b: dict, discount: float) -> dict | None:
    """The verdict on two texts (num, codes, words, runs, common: the share of their own runs that is common): how much each holds of the other, whether
    they are the same work, one contained in the other, or share a work; None if what they share is too little to be told."""
    shared = np.intersect1d(a["runs"], b["runs"])
    sizes = [len(np.unique(x["runs"])) * (1 - x["common"]) for x in (a, b)]
    effective = len(shared) * (1 - discount)
    matched = int(effective) + SIZE - 1
    if not len(shared) or matched < LIMITS["match_words"] or min(sizes) < 1:
        return None
    of = [min(1.0, effective / s) for s in sizes]
    sides = [blocks_of(x["codes"], x["words"], x["runs"], shared) for x in (a, b)]
    big = [[k for k in blocks if k["words"] >= LIMITS["big_words"] and k["purity"] >= LIMITS["big_purity"]] for blocks, _ in sides]
    cover = [sum(k["words"] * k["purity"] for k in big[i]) / max(1, int(x["words"].sum())) for i, x in enumerate((a, b))]
    same = min(of) >= LIMITS["same"] or min(cover) >= LIMITS["same_cover"]

    def holder(i: int) -> dict | None:
        """The block of one text that holds the other one."""
        best = max(sides[i][0], key=lambda k: (k["held"], -k["from"]), default=None)
        return best if best and best["held"] * (1 - discount) >= LIMITS["contained"] * sizes[1 - i] else None

    holds = [None, None] if same else [holder(0), holder(1)]
    if all(holds):  # the smaller one is the contained one
        small = min((0, 1), key=lambda i: (len(np.unique((a, b)[i]["runs"])), (a, b)[i]["num"]))
        holds[small] = None
    inside = min(sum(k["held"] for k in x) for x in big) / len(shared) if all(big) else 0.0
    clean, loose_clean = (bool(all(big)) and inside >= LIMITS[x] for x in ("clean", "container_clean"))
    if not (same or any(holds) or clean or loose_clean or max(of) >= LIMITS["listed"] or matched >= LIMITS["listed_words"]):
        return None
    relation = "same work" if same else "contained" if any(holds) else "shares a work" if clean else "partial"
    side = lambda i: {"of": round(of[i], 4), "loose": sides[i][1], "blocks": sides[i][0], "big": big[i], "holds": [holds[i]] if holds[i] else []}
    return {"matched_words": matched, "discount": round(discount, 4), "relation": relation, "clean": clean, "loose_clean": loose_clean, "a": side(0), "b": side(1)}


_BLOCK = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("words", pa.int32()), ("held", pa.int32()), ("purity", pa.float64()), ("spared", pa.list_(pa.list_(pa.int32())))])
_SIDE = pa.struct([("of", pa.float64()), ("loose", pa.int32()), *((n, pa.list_(_BLOCK)) for n in ("blocks", "big", "holds"))])
_PAIR = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("matched_words", pa.int32()), ("discount", pa.float64()), ("relation", pa.string()), ("clean", pa.bool_()), ("loose_clean", pa.bool_()), ("a", _SIDE), ("b", _SIDE)])
_block = "struct<`from`:int,`to`:int,words:int,held:int,purity:double,spared:array<array<int>>>"
_side = f"struct<`of`:double,loose:int,blocks:array<{_block}>,big:array<{_block}>,holds:array<{_block}>>"


def compare(pairs: DataFrame, encoded: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """x, y, verdict and both sides' blocks of every pair (x, y of num, each once) that is told.

    encoded: of encode(), stored. samples: num, sample (some of the text's runs, by whatever hash), common (those of them that too many texts have):
    the share of common ones among what two texts share of their samples discounts what they share. A null or unknown num drops its pair;
    the rows of a num that many pairs have are looked up salted."""
    each = encoded.select("num", "unit_words", "unit_codes", "runs")
    if samples is not None:
        each = each.join(samples.select("num", "sample", "common"), "num", "left")
    else:
        none = F.array().cast("array<long>")
        each = each.select("*", none.alias("sample"), none.alias("common"))
    each = stored(each)
    name = lambda k: each.select(F.col("num").alias(k), F.struct("unit_words", "unit_codes", "runs", "sample", "common").alias(f"{k}_"))
    distinct = pairs.select("x", "y").filter("x <> y").distinct()
    rows = salted_lookup(salted_lookup(distinct, name("x"), "x", spread=F.col("y")), name("y"), "y", spread=F.col("x"))
    met = F.array_intersect("x_.sample", "y_.sample")
    rows = rows.select("x", "y", "x_", "y_", met.alias("met"))
    share = lambda of, all_: F.when(F.size(all_) > 0, F.size(of) / F.size(all_)).otherwise(0.0)
    flat = rows.select(
        F.col("x").cast("long"), F.col("y").cast("long"), share(F.array_intersect("met", "x_.common"), F.col("met")).alias("discount"),
        *[c.alias(f"{k}{i}") for k in "xy" for i, c in enumerate((F.col(f"{k}_.unit_codes"), F.col(f"{k}_.unit_words"), F.col(f"{k}_.runs"), share(F.col(f"{k}_.common"), F.col(f"{k}_.sample"))))],
    )

    def run(batches):
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            array = lambda n, i, t: column[n][i].values.to_numpy(zero_copy_only=False).astype(t)  # noqa: B023, E731
            out = []
            for i in range(batch.num_rows):
                x, y = column["x"][i].as_py(), column["y"][i].as_py()
                a, b = ({"num": n, "codes": array(f"{k}0", i, np.int64), "words": array(f"{k}1", i, np.int64), "runs": array(f"{k}2", i, np.int64), "common": column[f"{k}3"][i].as_py() or 0.0} for k, n in (("x", x), ("y", y)))
                told = relate(a, b, column["discount"][i].as_py() or 0.0)
                if told:
                    out.append({"x": x, "y": y, **told})
            yield pa.RecordBatch.from_pylist(out, schema=_PAIR)

    return flat.mapInArrow(run, f"x long, y long, matched_words int, discount double, relation string, clean boolean, loose_clean boolean, a {_side}, b {_side}")


def edges_of(verdicts: DataFrame, nodes: DataFrame) -> DataFrame:
    """low, high, pos (the higher one's place), drops and reason, chosen blocks and why: what a told pair may do to its lower-ranked side.

    nodes: num, pos (anything in order, no two alike, the least is the highest rank), rough, container, reference, fixed. References neither act nor
    are acted upon; fixed texts act only."""
    n = nodes.filter("NOT reference").select("num", "pos", "rough", "container", "fixed")
    sides = F.array(F.struct(F.col("x").alias("num"), F.col("y").alias("other"), F.col("a").alias("own"), F.col("b").alias("its")), F.struct(F.col("y").alias("num"), F.col("x").alias("other"), F.col("b").alias("own"), F.col("a").alias("its")))
    both = verdicts.select("relation", "clean", "loose_clean", F.explode(sides).alias("s")).select("relation", "clean", "loose_clean", "s.*")
    e = both.join(n.filter("NOT fixed"), "num").join(n.select(F.col("num").alias("other"), F.col("pos").alias("above")), "other").filter("above < pos")
    spared = F.exists("own.blocks", lambda k: F.size(k["spared"]) > 0)
    whole = F.when(F.col("rough"), F.col("own.loose") < LIMITS["rough_unique"]).otherwise((F.col("own.loose") < LIMITS["unique"]) & ~spared)
    same, inside, contains = F.col("relation") == "same work", F.size("its.holds") > 0, F.size("own.holds") > 0
    part = (F.col("clean") | (F.col("container") & F.col("loose_clean"))) & ((F.col("own.of") < LIMITS["most_of"]) | (F.col("own.loose") >= LIMITS["unique"]))
    chosen = F.when(same | inside | (part & ~contains), F.col("own.big")).when(contains, F.col("own.holds"))
    kept = F.transform(chosen, lambda k: F.struct(k["from"].alias("from"), k["to"].alias("to"), F.when(F.col("rough"), F.array().cast("array<array<int>>")).otherwise(k["spared"]).alias("spared")))
    return e.select(
        F.col("num").alias("low"), F.col("other").alias("high"), F.col("above").alias("pos"), ((same | inside) & whole).alias("drops"),
        F.when(same, "same work").otherwise("contained in a document that outranks it").alias("reason"), kept.alias("chosen"), F.when(same | inside | ~contains, "shares a work").otherwise("contains").alias("why"),
    )


_OUT = pa.schema([("num", pa.int64()), ("fate", pa.string()), ("reason", pa.string()), ("counterpart", pa.int64()), ("keep", pa.list_(pa.list_(pa.int32()))), ("words_out", pa.int64()), ("edited", pa.bool_()), ("remnants", pa.list_(pa.list_(pa.int32())))])
_out = "num long, fate string, reason string, counterpart long, keep array<array<int>>, words_out long, edited boolean, remnants array<array<int>>"


def _settled(rows: DataFrame) -> DataFrame:
    """Outcomes of texts that aren't dropped whole: num, units (words, heading, line), cuts (unit, why, other), container, head and tail units of boilerplate."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                units = [(u["words"], u["heading"], u["line"] or "") for u in r["units"] or ()]
                n, first, last = len(units), r["head"], len(units) - r["tail"]
                cuts = sorted(r["cuts"] or (), key=lambda c: c["unit"])
                ranges: list[list[int]] = []
                for u in (c["unit"] for c in cuts):
                    if ranges and ranges[-1][1] == u:
                        ranges[-1][1] += 1
                    else:
                        ranges.append([u, u + 1])
                kept, remnants = settle(units, [tuple(x) for x in ranges], r["container"]) if ranges else ([(0, n)] if n else [], [])
                keep = [[max(a, first), min(b, last)] for a, b in kept if max(a, first) < min(b, last)]
                words = sum(units[i][0] for a, b in keep for i in range(a, b))
                if not words:
                    why = "nothing left after cuts" if cuts else "nothing but boilerplate"
                    out.append({"num": r["num"], "fate": "drop", "reason": why, "counterpart": cuts[0]["other"] if cuts else None, "keep": [], "words_out": 0, "edited": False, "remnants": []})
                else:
                    why = sorted({c["why"] for c in cuts} | ({"boilerplate"} if first or last < n else set()))
                    out.append({"num": r["num"], "fate": "keep", "reason": "; ".join(why) or None, "counterpart": cuts[0]["other"] if cuts else None, "keep": keep, "words_out": words, "edited": bool(why), "remnants": [list(x) for x in remnants]})
            yield pa.RecordBatch.from_pylist(out, schema=_OUT)

    return rows.mapInArrow(run, _out)


def decide_chain(nodes: DataFrame, edges: DataFrame, units: DataFrame) -> DataFrame:
    """num, fate (keep or drop), reason, counterpart, keep (ranges of units), words_out, edited, remnants of every node that is no reference.

    A text is decided by its higher-ranked neighbours that were not dropped, once all of them are decided: a whole layer at a time. It is dropped
    by the first that drops it; else the units of all chosen blocks, less those spared, are cut, headings and introductions go with long cuts, and
    a text with nothing left is dropped too. nodes: as of edges_of(), with head and tail. units: num and units (words, heading, line) of every node.
    What is collected for a text is one entry for each of its units at most."""
    nodes = stored(nodes)
    acting = nodes.filter("NOT reference").select("num", "container", "head", "tail")
    open_ = stored(edges)
    waiting = stored(acting)
    done: list[DataFrame] = []
    resolved: list[DataFrame] = []
    while not waiting.isEmpty():
        ready = stored(waiting.join(open_.select(F.col("low").alias("num")).distinct(), "num", "left_anti"))
        # what living neighbours do to the texts of this layer; edges of dropped ones were left out as they were resolved
        mine = functools.reduce(DataFrame.union, resolved).join(ready.select(F.col("num").alias("low")), "low", "left_semi") if resolved else edges.limit(0)
        mine = stored(mine)
        gone = stored(mine.filter("drops").groupBy(F.col("low").alias("num")).agg(F.min(F.struct("pos", "reason", "high")).alias("by")))
        cut = mine.join(gone.select(F.col("num").alias("low")), "low", "left_anti").filter("chosen IS NOT NULL").select("low", "high", "pos", "why", F.explode("chosen").alias("k"))
        unit = cut.filter(F.col("k.to") > F.col("k.from")).select("low", "high", "pos", "why", "k.spared", F.explode(F.sequence(F.col("k.from"), F.col("k.to") - 1)).alias("unit"))
        unit = unit.filter(~F.exists("spared", lambda s: (F.col("unit") >= s[0]) & (F.col("unit") < s[1])))
        first = unit.groupBy("low", "unit").agg(F.min(F.struct("pos", "why", F.col("high").alias("other"))).alias("c"))
        cuts = first.groupBy(F.col("low").alias("num")).agg(F.collect_list(F.struct("unit", F.col("c.why").alias("why"), F.col("c.other").alias("other"))).alias("cuts"))
        left = ready.join(gone.select("num"), "num", "left_anti").join(units, "num").join(cuts, "num", "left").select("num", "units", "cuts", "container", "head", "tail")
        none = F.array().cast("array<array<int>>")
        dropped = gone.select("num", F.lit("drop").alias("fate"), F.col("by.reason").alias("reason"), F.col("by.high").alias("counterpart"), none.alias("keep"), F.lit(0).cast("long").alias("words_out"), F.lit(False).alias("edited"), none.alias("remnants"))
        now = stored(_settled(left).union(dropped))
        settled = salted_lookup(open_, stored(now.select(F.col("num").alias("high"), "fate")), "high", "left", spread=F.col("low"))
        settled = stored(settled)
        resolved.append(stored(settled.filter("fate = 'keep'").select(*edges.columns)))
        still = stored(settled.filter("fate IS NULL").select(*edges.columns))
        rest = stored(waiting.join(ready.select("num"), "num", "left_anti"))
        for t in (open_, waiting, ready, mine, gone, settled):
            drop_stored(t)
        done.append(now)
        open_, waiting = still, rest
    return functools.reduce(DataFrame.union, done) if done else _settled(acting.limit(0).join(units, "num").withColumn("cuts", F.array().cast("array<struct<unit:int,why:string,other:long>>")).select("num", "units", "cuts", "container", "head", "tail"))


def records(files: DataFrame, leaders: DataFrame, outcomes: DataFrame, units: DataFrame) -> DataFrame:
    """One record for each file: source, path, doc, action (keep, edit, drop), reason, counterpart (a path), words, words_out, keep_units.

    files: source, path, num, kind, first (whether it is the text's first path). leaders: num and leader of texts of equal bodies. Files of reference
    sources have no record. Copies of a file are dropped as identical files, copies of a text as identical texts, or for the reason their leader was."""
    size = units.select("num", F.aggregate("units", F.lit(0), lambda s, u: s + u["words"]).alias("words"))
    path_of = files.filter("first").select(F.col("num").alias("counterpart"), F.col("path").alias("by"))
    f = files.filter("kind <> 'reference'").join(leaders, "num", "left").withColumn("leader", F.coalesce("leader", "num"))
    o = outcomes.withColumnRenamed("num", "leader")
    j = f.join(o, "leader", "left").join(size, "num", "left")
    follower = F.col("leader") != F.col("num")
    with_it = follower & (F.col("fate") == "drop") & F.col("counterpart").isNotNull()
    twin = ~F.col("first") & (F.col("kind") != "read") & (F.col("fate") != "drop") & ~follower
    action = F.when(follower | twin | (F.col("fate") == "drop"), "drop").when(F.col("edited"), "edit").otherwise("keep")
    reason = F.when(with_it, F.col("reason")).when(follower, "identical text").when(twin, "identical file").otherwise(F.col("reason"))
    other: Column = F.when(with_it, F.col("counterpart")).when(follower, F.col("leader")).when(twin, F.col("num")).otherwise(F.col("counterpart"))
    rows = j.select("source", "path", F.col("num").alias("doc"), action.alias("action"), reason.alias("reason"), other.alias("counterpart"), "words", F.when(action == "drop", 0).otherwise(F.col("words_out")).alias("words_out"), F.when(action == "edit", F.col("keep")).alias("keep_units"))
    return salted_lookup(rows, stored(path_of), "counterpart", "left", spread=F.col("path")).drop("counterpart").withColumnRenamed("by", "counterpart")


def applied(texts: DataFrame, plan: DataFrame) -> DataFrame:
    """path and text of what a plan of records leaves of each file. texts: path, lines (its units)."""
    kept = F.when(F.col("action") == "edit", F.flatten(F.transform("keep_units", lambda r: F.slice("lines", r[0] + 1, r[1] - r[0])))).otherwise(F.col("lines"))
    return texts.join(plan.filter("action <> 'drop'").select("path", "action", "keep_units"), "path").select("path", F.array_join(kept, "\n").alias("text"))
