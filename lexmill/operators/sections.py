"""Texts into parts: stories by headings, sections of books with their kinds, wrappers at the edges of pages."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: How headings, markers and apparatus are told.
HEADING = r"^(?:(?:chapter|part|book|kapitel|chapitre|capítulo|rozdział|глава)\s+(?:[0-9]+|[ivxlc]+)\b.*|[IVXLC]+\.?|#{1,3} .+)$"
MARKERS = {"comments": r"^(?:\d+ )?(?:comments?|responses?|replies)\b.{0,40}$", "bio": r"^about the author\b.{0,40}$", "note": r"^(?:author['’]?s? note|a/n|notes?)\b:?.{0,40}$"}
WRAPPER = r"(?:copyright|all rights reserved|subscribe|share |filed under|skip to|next chapter|previous chapter|advertisement|read for you|©)"
APPARATUS = ("introduction", "foreword", "preface", "afterword", "acknowledgments", "acknowledgements", "permissions", "about the author", "contributors", "contents", "further reading", "copyright")
ZONE, HEAD_WORDS, TAIL_SHARE, TAIL_WORDS, SANDWICH, LEAST_BODY = 14, 600, 0.35, 2500, 14, 150


def story_split(df: DataFrame, key: str, text: str = "text", heading: str = HEADING, separator: str = "\n") -> DataFrame:
    """key, part, heading, text, whole: the lines between headings, in order; whole tells that the parts give back the text.

    Cumulative sums of heading marks number the parts; the check joins them again. Texts without a heading are one part 0."""
    lines = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.posexplode(F.split(text, separator)).alias("n", "line"))
    mark = F.lower(F.trim("line")).rlike(heading.lower().replace("[ivxlc]", "[ivxlc]")) | F.trim("line").rlike(heading)
    w = W.partitionBy("key").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    parts = lines.withColumn("h", mark).withColumn("part", F.sum(F.col("h").cast("int")).over(w))
    # lines of one part: bounded by the text they come from
    each = parts.groupBy("key", "part").agg(F.min(F.when(F.col("h"), F.trim("line"))).alias("heading"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), separator).alias("text"))
    again = each.groupBy("key").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), separator)).alias("m"))
    ok = again.join(df.select(F.col(key).alias("key"), F.md5(text).alias("o")), "key").select("key", (F.col("m") == F.col("o")).alias("whole"))
    return each.join(ok, "key").withColumnRenamed("key", key)


def cut_edges(paragraphs: list[str]) -> tuple[int, int, list[str]]:
    """(first, end, reasons): the body is paragraphs[first:end].

    A marker line in the last half cuts to the end; then the edges are walked inward over wrapper paragraphs, taking up to two short ones
    between them; a cut that would leave too little body is refused whole."""
    n = len(paragraphs)
    size = [len(p.split()) for p in paragraphs]
    total = sum(size)
    first, end, why = 0, n, []
    upto = 0
    for i, p in enumerate(paragraphs):
        upto += size[i]
        if upto > total / 2 and size[i] <= 8:
            kind = next((k for k, rx in MARKERS.items() if re.match(rx, p.strip(), re.I)), None)
            if kind and sum(size[i:]) <= (total if kind == "comments" else min(TAIL_WORDS, 0.35 * total + 40)):
                end = i
                why.append(kind)
                break

    def walk(order: Iterator[int], most: float) -> int:
        """How many paragraphs from the edge inward are wrappers or caught between them."""
        taken = waiting = words = loose = 0
        for k, i in enumerate(order):
            if k >= ZONE:
                break
            words += size[i]
            if words > most:
                break
            if re.search(WRAPPER, paragraphs[i], re.I) and size[i] <= 60:
                taken, waiting = k + 1, 0
            elif size[i] <= SANDWICH and waiting < 2:
                waiting += 1
                loose += 1
            else:
                break
        return taken

    head = walk(iter(range(0, end)), HEAD_WORDS)
    tail = walk(iter(range(end - 1, -1, -1)), min(TAIL_WORDS, TAIL_SHARE * max(total, 1)))
    if head:
        first = head
        why.append("head")
    if tail and end - tail > first:
        end -= tail
        why.append("tail")
    if sum(size[first:end]) < LEAST_BODY and (first, end) != (0, n):
        return 0, n, ["refused"]
    return first, end, why


def edges(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, first, end, paragraphs, reasons of the body of each text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for k, t in zip(b["key"], b["text"], strict=True):
                ps = [p for p in (t or "").split("\n") if p.strip()]
                first, end, why = cut_edges(ps)
                rows.append((k, first, end, len(ps), why))
            yield pd.DataFrame(rows, columns=["key", "first", "end", "paragraphs", "reasons"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key {kind}, first int, end int, paragraphs int, reasons array<string>").withColumnRenamed("key", key)


def book_sections(text: str) -> list[dict]:
    """Sections of a book: contents pages (more than five headings running), apparatus by title, front matter before the first heading,
    stories else; each with its first line, lines and words."""
    lines = text.split("\n")
    heads = [i for i, x in enumerate(lines) if re.match(HEADING, x.strip(), re.I) or x.strip().lower() in APPARATUS]
    runs, contents = [], set()
    for i in heads:
        between = [x for x in lines[runs[-1][-1] + 1 : i] if x.strip()] if runs else [""]
        if runs and not between:
            runs[-1].append(i)
        else:
            runs.append([i])
    for r in runs:
        if len(r) > 5:
            contents.update(r)
    starts = [r[0] for r in runs]
    out = []
    for a, b in zip([0, *starts] if not starts or starts[0] else starts, [*starts, len(lines)] if not starts or starts[0] else [*starts[1:], len(lines)], strict=True):
        title = lines[a].strip() if a in starts else ""
        body = "\n".join(lines[a:b])
        words = len(body.split())
        kind = "contents" if a in contents else "apparatus" if title.lower() in APPARATUS else "front" if a not in starts else "story" if words >= 30 else "stub"
        if words:
            out.append({"line": a + 1, "lines": b - a, "words": words, "title": title, "kind": kind})
    return out


def sections(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key and one row for each section."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [{"key": k, **s} for k, t in zip(b["key"], b["text"], strict=True) if t for s in book_sections(t)]
            yield pd.DataFrame(rows, columns=["key", "line", "lines", "words", "title", "kind"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key {kind}, line int, lines int, words int, title string, kind string").withColumnRenamed("key", key)


def section_kinds(df: DataFrame, doc: str, order: str, title: Column, text: Column) -> DataFrame:
    """Parts of a book, in order, as front, body or back: strong reasons from titles span the body, what lies outside it follows its zone."""
    strong = F.when(F.lower(F.trim(title)).isin(*APPARATUS), "apparatus").when(F.size(F.split(text, r"\s+")) >= 30, "body")
    marked = df.withColumn("_strong", strong)
    w = W.partitionBy(doc)
    lo, hi = F.min(F.when(F.col("_strong") == "body", F.col(order))).over(w), F.max(F.when(F.col("_strong") == "body", F.col(order))).over(w)
    zone = F.when(F.col(order) < F.col("_lo"), "front").when(F.col(order) > F.col("_hi"), "back").otherwise("body")
    return marked.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("zone", zone).withColumn("kind", F.coalesce("_strong", "zone")).drop("_strong", "_lo", "_hi")
