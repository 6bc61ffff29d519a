"""Mixing sources to target weights (problem 9).

Texts, not rows, are mixed: a text that stands in several rows counts once, and one that stands in several sources may serve any of them.
1. Texts are aggregated by their membership pattern, the set of sources they stand in, with the tokens of each pattern.
2. For each mix a min-cost flow routes the patterns' tokens to the sources' quotas: the first use of a token costs nothing, the k-th use
   k - 1, up to the least max_repeats among the pattern's sources; so small sources are repeated only as far as needed, evenly, and texts
   of several sources go where they are needed. The graph has patterns and sources for nodes, not texts; all patterns take part.
3. Texts are selected along a seeded order: a pattern's texts lie one behind the other on a line, the pattern's flow runs over the line in
   laps, and each source takes its part of that way. Running sums are built over buckets of the order first, so no task sees a whole pattern.

A mix's size is that of all distinct texts of its sources with a weight, unless given. Where a source can't fill its quota even with
repeats, the mix falls short by that much and the actual shares show it.

Defined results: null and empty texts and texts of null sources or sources without weight are not chosen; null, negative and NaN weights
are 0, a null max_repeats is 1, one below 1 excludes the source; repeated weight rows of a source add up, with the least max_repeats; empty
tables give no rows; equal seeds give equal choices whatever the order of rows; further columns are left out."""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.token_budget import count_tokens
from lexmill.scale import salted_lookup, small, stored, table

#: Texts of one bucket of the seeded order.
BUCKET_TEXTS = 20_000


def send(usable: dict[tuple[str, ...], list[str]], size: dict[tuple[str, ...], int], most: dict[tuple[str, ...], int], quota: dict[str, int]) -> dict[tuple[str, ...], dict[str, int]]:
    """The min-cost flow: tokens that each pattern sends to each source.

    A path's cost is that of the use it begins with, so uses are sent in turn: all first ones, then all second ones. Within a use a pattern's
    tokens look for a source with room, moving others' tokens from source to source where needed. The search goes over sources, not patterns;
    sources from which none with room is reached never reach one again. The work grows in proportion to the patterns."""
    left, full = dict(quota), set()
    sent: dict[tuple[str, ...], dict[str, int]] = {p: {} for p in usable}
    # source -> other source -> patterns that send to the one and may send to the other; entries that no longer hold are dropped when met
    movable: dict[str, dict[str, list[tuple[str, ...]]]] = {s: {} for s in quota}

    def add(p: tuple[str, ...], s: str, n: int) -> None:
        if s not in sent[p]:
            for other in usable[p]:
                if other != s:
                    movable[s].setdefault(other, []).append(p)
        sent[p][s] = sent[p].get(s, 0) + n

    def way(p: tuple[str, ...]) -> list[tuple[str, tuple[str, ...], str]] | str | None:
        """The moves to a source with room, from it back to the source that p sends to; that source alone if it has room itself."""
        via: dict = {s: None for s in usable[p] if s not in full}
        queue = deque(via)
        while queue:
            s = queue.popleft()
            if left[s] > 0:
                moves = []
                while via[s]:
                    moves.append((*via[s], s))
                    s = via[s][0]
                return moves or s
            for other, patterns in movable[s].items():
                if other in via or other in full:
                    continue
                while patterns and s not in sent[patterns[-1]]:
                    patterns.pop()
                if patterns:
                    via[other] = (s, patterns[-1])
                    queue.append(other)
        full.update(via)
        return None

    waiting, use = sorted(usable), 0
    while waiting := [p for p in waiting if most[p] > use and not full.issuperset(usable[p])]:
        for p in waiting:
            tokens = size[p]
            while tokens and (found := way(p)):
                moves = [] if isinstance(found, str) else found
                first, last = (moves[-1][0], moves[0][2]) if moves else (found, found)
                n = min(tokens, left[last], *[sent[q][s] for s, q, _ in moves])
                for s, q, other in moves:
                    sent[q][s] -= n
                    if not sent[q][s]:
                        del sent[q][s]
                    add(q, other, n)
                add(p, first, n)
                left[last] -= n
                tokens -= n
        use += 1
    return sent


def route(patterns: dict[tuple[str, ...], int], weights: dict[str, float], repeats: dict[str, int], total: int | None = None) -> tuple[dict[tuple[str, ...], dict[str, int]], dict[str, int]]:
    """Tokens that each pattern gives to each source, and the quotas. patterns: tokens of the texts that stand in just these sources."""
    live = {s: w for s, w in weights.items() if w and w > 0 and math.isfinite(w) and repeats.get(s, 1) >= 1}
    usable = {p: [s for s in p if s in live] for p in patterns}
    usable = {p: m for p, m in usable.items() if m and patterns[p] > 0}
    size = sum(patterns[p] for p in usable) if total is None else total
    whole = sum(live.values())
    quota = {s: int(size * w / whole) for s, w in live.items()}
    most = {p: min(repeats.get(s, 1) for s in m) for p, m in usable.items()}
    return send(usable, patterns, most, quota), quota


def _texts(docs: DataFrame, seed: int) -> DataFrame:
    """One stored row for each distinct text: tokens, pattern, members (source, doc_id), and its place at (first token) in its pattern's order."""
    usable = docs.filter("source IS NOT NULL AND text IS NOT NULL AND text <> ''").select("doc_id", "source", F.md5("text").alias("h"), "text")
    counted = count_tokens(usable)
    by_source = counted.groupBy("h", "source").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens"))
    members = by_source.groupBy("h").agg(F.max("tokens").alias("tokens"), F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("members")).filter("tokens > 0")
    texts = stored(members.withColumn("pattern", F.transform("members", lambda m: m["source"])).withColumn("order", F.xxhash64("h", F.lit(seed))))
    buckets = max(64, texts.count() // BUCKET_TEXTS)
    placed = texts.withColumn("bucket", F.pmod(F.col("order"), F.lit(buckets)))
    from pyspark.sql import Window as W

    sums = placed.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("t"))
    before = stored(sums.withColumn("base", F.sum("t").over(W.partitionBy("pattern").orderBy("bucket")) - F.col("t")).select("pattern", "bucket", "base"))
    inner = W.partitionBy("pattern", "bucket").orderBy("order", "h")
    return stored(placed.join(small(before), ["pattern", "bucket"]).withColumn("at", F.col("base") + F.sum("tokens").over(inner) - F.col("tokens")).select("tokens", "pattern", "members", "at"))


def mix(docs: DataFrame, weights: DataFrame, total: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Chosen texts (mix, source, doc_id, repeats, tokens) and shares (mix, source, weight, target_share, quota, tokens, actual_share, texts).

    weights is a small table (a row for each mix and source) and is read on the driver; so are the patterns' sizes."""
    spark = docs.sparkSession
    texts = _texts(docs, seed)
    patterns = {tuple(r["pattern"]): r["t"] for r in texts.groupBy("pattern").agg(F.sum("tokens").alias("t")).collect()}
    mixes: dict[str, dict[str, list]] = {}
    for r in weights.select("mix", "source", "weight", "max_repeats").collect():
        if r["source"] is None:
            continue
        w = r["weight"] if r["weight"] is not None and math.isfinite(r["weight"]) and r["weight"] > 0 else 0.0
        own = mixes.setdefault(r["mix"], {}).setdefault(r["source"], [0.0, 1 << 30])
        own[0] += w
        own[1] = min(own[1], 1 if r["max_repeats"] is None else r["max_repeats"])
    parts, goals = [], []
    for name, own in sorted(mixes.items(), key=lambda x: str(x[0])):
        sent, quota = route(patterns, {s: v[0] for s, v in own.items()}, {s: v[1] for s, v in own.items()}, total)
        for p, to in sent.items():
            at, ways = 0, []
            for s, n in sorted(to.items()):
                ways.append((s, at, at + n))
                at += n
            if ways:
                parts.append((name, list(p), patterns[p], at, ways))
        whole = sum(v[0] for v in own.values())
        goals += [(name, s, v[0], v[0] / whole if whole else 0.0, quota.get(s, 0)) for s, v in own.items()]
    plan = spark.createDataFrame(parts, "mix string, pattern array<string>, size long, used long, ways array<struct<source:string,a:long,b:long>>")
    plan = stored(plan.groupBy("pattern").agg(F.collect_list(F.struct("mix", "size", "used", "ways")).alias("plans")))
    laps = F.sequence(F.lit(0), F.ceil(F.col("used") / F.col("size")).cast("int"))
    middle = F.col("at") + F.floor(F.col("tokens") / 2)
    rows = salted_lookup(texts, plan, "pattern", spread=F.col("at")).select("tokens", "members", "at", F.explode("plans").alias("plan")).select("tokens", "members", "at", "plan.*")
    users = F.flatten(F.transform(laps, lambda k: F.transform(F.filter("ways", lambda w: (middle + k * F.col("size") >= w["a"]) & (middle + k * F.col("size") < w["b"])), lambda w: w["source"])))
    used = rows.select("mix", "tokens", "members", users.alias("users")).filter(F.size("users") > 0)
    each = used.select("mix", "tokens", "members", "users", F.explode(F.array_distinct("users")).alias("source"))
    doc = F.element_at(F.filter("members", lambda m: m["source"] == F.col("source")), 1)["doc_id"]
    chosen = each.select("mix", "source", doc.alias("doc_id"), F.size(F.filter("users", lambda u: u == F.col("source"))).alias("repeats"), "tokens")
    goal = spark.createDataFrame(goals, "mix string, source string, weight double, target_share double, quota long")
    got = chosen.groupBy("mix", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("texts"), F.max("repeats").alias("most_repeats"))
    from pyspark.sql import Window as W

    shares = goal.join(F.broadcast(got), ["mix", "source"], "left").fillna(0, ["tokens", "texts", "most_repeats"])  # both sides: rows of the weights
    shares = shares.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(W.partitionBy("mix")), F.lit(0)), F.lit(0.0)))
    return chosen, shares


def p9_mix(spark, d):
    return mix(table(spark, d, "documents"), table(spark, d, "mix_weights"))[0]


def p9_shares(spark, d):
    return mix(table(spark, d, "documents"), table(spark, d, "mix_weights"))[1]


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
