"""After the cuts: what goes with a cut, what is left stranded, and cleaning of fan texts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEADING_CUT, HEADING_UNITS, INTRO_WORDS, INTRO_UNITS, REMNANT_WORDS = 1000, 4, 500, 6, 80


def settle(units: list[tuple[int, bool, str]], cuts: list[tuple[int, int]], container: bool = False) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(kept runs, remnants) as half-open ranges of units (words, heading, text), given the ranges that are cut.

    A cut of many words takes up to four headings right before it; in a container it also takes an editor's introduction before those - few
    and short paragraphs one of which names a word of the heading. What stands between two cuts, or a cut and an edge, and is hardly more
    than a heading is a remnant and goes too."""
    n = len(units)
    gone = [False] * n
    for a, b in sorted(cuts):
        a, b = max(0, a), min(n, b)
        for i in range(a, b):
            gone[i] = True
        words = sum(units[i][0] for i in range(a, b))
        heads = []
        if words >= HEADING_CUT:
            i = a - 1
            while i >= 0 and units[i][1] and not gone[i] and len(heads) < HEADING_UNITS:
                heads.append(i)
                i -= 1
        for i in heads:
            gone[i] = True
        if container and heads:
            names = {w.lower() for h in heads for w in re.findall(r"\w{4,}", units[h][2])}
            i, intro, total = min(heads) - 1, [], 0
            while i >= 0 and not gone[i] and not units[i][1] and len(intro) < INTRO_UNITS and total + units[i][0] <= INTRO_WORDS:
                intro.append(i)
                total += units[i][0]
                i -= 1
            closed = i < 0 or gone[i] or units[i][1]
            if closed and intro and any(names & {w.lower() for w in re.findall(r"\w{4,}", units[k][2])} for k in intro):
                for k in intro:
                    gone[k] = True
    remnants, kept, i = [], [], 0
    while i < n:
        if gone[i]:
            i += 1
            continue
        j = i
        while j < n and not gone[j]:
            j += 1
        words = sum(units[k][0] for k in range(i, j))
        if (i or j < n) and words <= REMNANT_WORDS and all(units[k][1] for k in range(i, j)):
            remnants.append((i, j))
        else:
            kept.append((i, j))
        i = j
    return kept, remnants


def settled(docs: DataFrame, key: str = "num") -> DataFrame:
    """key, keep, remnants of documents with units (array of words, heading, text), cuts (array of a, b) and container."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for k, u, c, box in zip(b["key"], b["units"], b["cuts"], b["container"], strict=True):
                keep, left = settle([(x["words"], x["heading"], x["text"] or "") for x in (u if u is not None else [])], [(x["a"], x["b"]) for x in (c if c is not None else [])], bool(box))
                rows.append((k, [list(r) for r in keep], [list(r) for r in left]))
            yield pd.DataFrame(rows, columns=["key", "keep", "remnants"])

    return docs.select(F.col(key).alias("key"), "units", "cuts", "container").mapInPandas(run, f"key {kind}, keep array<array<int>>, remnants array<array<int>>").withColumnRenamed("key", key)


_HEAD_NOTE = re.compile(r"^(?:disclaimer|summary|rating|pairing|author'?s? note|a/n|beta|warnings?|title|fandom)\s*[:.-]", re.I)
_TAIL_NOTE = re.compile(r"^(?:a/n|author'?s? note|please review|r&r|reviews? (?:are|make)|to be continued|tbc|the end)\b", re.I)
_BREAK = re.compile(r"^\W{3,}$")


def fan_clean(text: str) -> str:
    """A story without its header lines, author's notes at the ends and site marks; scene breaks in one style."""
    lines = [x.strip() for x in text.split("\n")]
    while lines and (not lines[0] or _HEAD_NOTE.match(lines[0]) or _BREAK.match(lines[0])):
        lines.pop(0)
    while lines and (not lines[-1] or _TAIL_NOTE.match(lines[-1]) or _BREAK.match(lines[-1])):
        lines.pop()
    out: list[str] = []
    for x in lines:
        x = "* * *" if _BREAK.match(x) else re.sub(r"^\(?a/n:.*?\)?$", "", x, flags=re.I)
        if x and not (x == "* * *" and out and out[-1] == "* * *"):
            out.append(x)
    return "\n".join(out)


def cleaned_fan_texts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "text": [None if t is None else fan_clean(t) for t in b["text"]]})

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key {kind}, text string").withColumnRenamed("key", key)


def spaced(findings: DataFrame, key: str, at: str, reach: int) -> DataFrame:
    """Findings that don't stand within `reach` of an earlier one that is kept, from the first on.

    Runs of findings less than `reach` apart decide among themselves; only such a run, not a whole file, is walked in order."""
    w = W.partitionBy(key).orderBy(at)
    runs = findings.withColumn("_cut", F.when(F.col(at) - F.lag(at).over(w) <= reach, 0).otherwise(1)).withColumn("_run", F.sum("_cut").over(w))
    lists = runs.groupBy(key, "_run").agg(F.array_sort(F.collect_set(at)).alias("_a"))
    kept = F.aggregate("_a", F.array().cast("array<int>"), lambda s, x: F.when((F.size(s) == 0) | (x - F.try_element_at(s, F.lit(-1)) > reach), F.concat(s, F.array(x.cast("int")))).otherwise(s))
    return lists.select(key, F.explode(kept).alias(at))


def first_seen_paths(paths: DataFrame, tree: str = "tree", path: str = "path", nodes: str = "nodes") -> DataFrame:
    """tree, path, new: the nodes each path adds, the longest path first: a node belongs to the first path that holds it."""
    ranked = paths.withColumn("_r", F.struct((-F.size(nodes)).alias("n"), F.col(path).alias("p")))
    each = ranked.select(tree, path, "_r", F.posexplode(nodes).alias("i", "node"))
    first = each.groupBy(tree, "node").agg(F.min("_r").alias("_r"))
    mine = each.join(first, [tree, "node", "_r"], "left_semi")
    return mine.groupBy(tree, path).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "node"))), lambda x: x["node"]).alias("new"))


def longest_prefixes(tokens: list[str], known: dict[str, str], separator: str = ", ") -> list[str]:
    """A comma list resolved by the longest known names: at each place the longest run of tokens that is a known name is taken."""
    out, i = [], 0
    while i < len(tokens):
        for j in range(len(tokens), i, -1):
            name = separator.join(tokens[i:j])
            if name in known:
                out.append(known[name])
                i = j
                break
        else:
            i += 1
    return out
