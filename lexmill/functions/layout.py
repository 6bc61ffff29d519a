"""Layout of texts that patterns alone can't mend: Arrow-batched functions for wraps, breaks, tags and norms."""

from __future__ import annotations

import functools
import os
import re
import statistics
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_glue = re.compile("(?<=\\w)['’­​‌‍](?=\\w)")
_alnum = re.compile(r"[^\W_]+")


@functools.lru_cache(maxsize=200_000)
def _norm_word(w: str) -> tuple[str, ...]:
    folded = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", w).casefold())
    return tuple(_alnum.findall("".join(c for c in folded if unicodedata.category(c) != "Mn")))


def norm_words(text: str) -> list[str]:
    """Words for comparison: runs of letters and digits, glued over apostrophes, soft hyphens and hyphenated line ends, folded, without marks."""
    text = re.sub(r"(?<=\w)[-‐]\n\s*(?=\w)", "", unicodedata.normalize("NFC", text))
    out: list[str] = []
    for w in _alnum.findall(_glue.sub("", text)):
        out += _norm_word(w)
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def norm_tokens(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else norm_words(t))


def wrap_mode(text: str) -> str:
    """How lines were broken: plain (a line is a paragraph), filled (hard wraps, blank lines between paragraphs), doubled (a blank line after
    every line of a wrapped text), verse (short lines that don't fill)."""
    lines = text.split("\n")
    full = [len(x.rstrip()) for x in lines if x.strip()]
    if len(full) < 6:
        return "plain"
    blank = sum(not x.strip() for x in lines) / len(lines)
    p50, p90 = statistics.median(full), sorted(full)[int(len(full) * 0.9)]
    if p90 > 100:
        return "plain"
    open_ends = sum(bool(re.search(r"[\w,;]$", x.rstrip())) for x in lines if x.strip()) / len(full)
    if p50 < 0.6 * p90 and open_ends > 0.5:
        return "verse"
    if blank > 0.45 and open_ends > 0.4:
        return "doubled"
    return "filled" if open_ends > 0.4 and p50 >= 0.75 * p90 else "plain"


def unwrapped(text: str) -> str:
    """The text with wrapped lines joined to paragraphs, words broken by a hyphen at a line's end made whole."""
    mode = wrap_mode(text)
    if mode in ("plain", "verse"):
        return text
    if mode == "doubled":
        lines, paragraphs = [x.strip() for x in text.split("\n") if x.strip()], [""]
        for x in lines:
            if paragraphs[-1] and re.search(r"[.!?…]['\"’”»]*$", paragraphs[-1]) and x[:1].isupper() and len(paragraphs[-1]) > 200:
                paragraphs.append("")
            paragraphs[-1] = (paragraphs[-1] + "\n" + x).strip("\n")
    else:
        paragraphs = [p for p in re.split(r"\n[ \t\r]*\n\s*", text) if p.strip()]
    join = lambda p: re.sub(r"\s*\n\s*", " ", re.sub(r"(?<=[a-zà-ÿ])-\n\s*(?=[a-zà-ÿ])", "", p.strip()))
    return "\n\n".join(map(join, paragraphs))


@F.pandas_udf(T.StringType())
def unwrap_lines(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unwrapped(t))


def mend_word(pieces: str, vocabulary: dict[str, float], longest: int = 24) -> str:
    """Letters with stray blanks cut into words of the vocabulary at the least cost, by dynamic programming; unknown letters cost most."""
    letters = pieces.replace(" ", "")
    best: list[tuple[float, int]] = [(0.0, 0)] + [(float("inf"), 0)] * len(letters)
    for i in range(1, len(letters) + 1):
        for j in range(max(0, i - longest), i):
            w = letters[j:i]
            cost = vocabulary.get(w.lower())
            cost = best[j][0] + (cost if cost is not None else 20.0 + 10.0 * len(w))
            if cost < best[i][0]:
                best[i] = (cost, j)
    out, i = [], len(letters)
    while i:
        out.append(letters[best[i][1] : i])
        i = best[i][1]
    return " ".join(reversed(out))


#: Runs of three short pieces or more, as broken words have them.
_odd = r"\w\u00ad\u200b-\u200d\u2060\ufeff"
BROKEN_RUN = rf"(?<![{_odd}])[A-Za-z]{{1,4}}(?: [A-Za-z]{{1,4}}){{2,}}(?![{_odd}])"


def mend_breaks(text: str, vocabulary: dict[str, float]) -> str:
    """Runs of short pieces that are no words, as bad scans have them, are cut anew."""
    def fix(m: re.Match) -> str:
        parts = m.group().split(" ")
        if all(p.lower() in vocabulary for p in parts):
            return m.group()
        new = mend_word(m.group(), vocabulary)
        whole = new.split(" ")
        # a run of words that aren't known is left alone: only fewer pieces that all are words mend anything
        return new if len(whole) < len(parts) and all(p.lower() in vocabulary for p in whole) else m.group()

    return re.sub(BROKEN_RUN, fix, text)


def mended(df: DataFrame, vocabulary: DataFrame, text: str = "text", out: str = "text", words: int = 50_000) -> DataFrame:
    """df with broken words mended by a vocabulary (word of a-z, n). Which pieces are words is told by all words of at most four letters, of which
    there are less than 476,000; how a run is cut anew by these and the `words` most frequent longer ones, a documented bound of the model."""
    import math

    short = F.length("word") <= 4
    top = vocabulary.filter(short).union(vocabulary.filter(~short).orderBy(F.desc("n"), "word").limit(words)).collect()
    total = sum(r["n"] for r in top) or 1
    costs = {r["word"]: -math.log(r["n"] / total) for r in top}
    shared = df.sparkSession.sparkContext.broadcast(costs)

    @F.pandas_udf(T.StringType())
    def fix(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else mend_breaks(t, shared.value))

    return df.withColumn(out, fix(F.col(text)))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("tag", T.StringType()), T.StructField("text", T.StringType())])))
def inline_tags(s: pd.Series) -> pd.Series:
    """Segments of <name>...</name> in order; the first of each name stands, an unclosed one runs to the end."""
    def parse(t):
        if t is None:
            return None
        out, seen = [], set()
        for m in re.finditer(r"<([a-z_]+)>(.*?)(?:</\1>|$)", t, re.S):
            if m.group(1) not in seen:
                seen.add(m.group(1))
                out.append({"tag": m.group(1), "text": m.group(2).strip()})
        return out

    return s.map(parse)


def quoted(quote: str, options: list[str]) -> int | None:
    """The option a quotation is from: by containment, else by the longest common beginning; None for a tie or nothing in common."""
    inside = [i for i, o in enumerate(options) if quote and quote in o]
    if inside:
        return inside[0] if len(inside) == 1 else None
    common = [len(os.path.commonprefix([quote, o])) for o in options]
    best = max(common, default=0)
    return common.index(best) if best and common.count(best) == 1 else None


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunks(s: pd.Series, size: pd.Series) -> pd.Series:
    """Pieces of at least `size` characters, cut behind the first blank line from there on, which put together give the text."""
    def cut(t, n):
        if t is None:
            return None
        out, at = [], 0
        for m in re.finditer(r"^[ \t\r]*\n", t, re.M):
            if m.end() - at >= n and m.end() < len(t):
                out.append(t[at : m.end()])
                at = m.end()
        return [*out, t[at:]]

    return pd.Series([cut(t, n) for t, n in zip(s, size, strict=True)])
