"""Garbled text from wrong character encoding (problem 4).

1. Records are joined with near-twins on what is left without non-ASCII characters: words (at least two ASCII letters) and, for scripts
   that leave no letters, whole lines of a source that hold a word without ASCII letters. Of the forms of a twin group the one in most
   files counts as clean; each other form is paired with that one only, so a group makes no more pairs than it has forms.
2. The characters between equal ASCII characters are aligned. A transformation - bytes by one encoding, read by another - is learned if
   it turns the clean side into the garbled one for several different runs of characters, more often than its inverse does.
3. Transformations out of UTF-8 give a table from garbled sequences to characters, for all characters of the blocks seen; it is applied to
   every line, again for text that was garbled twice. Transformations between single-byte encodings turn words into words that look
   sound, so a word counts as garbled only if its restored form stands in many times as many files.
Replacement characters and C1 controls are garbled wherever they stand; they are reported though they can't be restored.

Defined results: null and empty texts have no lines; a file that stands twice gives its rows twice; an empty table gives no rows; lines
are restored whole, other lines stay as they are; what was lost (U+FFFD) stays; columns besides source, path and text are left out."""

from __future__ import annotations

import functools
import re
import unicodedata as U

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.scale import small, stored, table

#: Encodings in use, by the names of Python's codecs.
SINGLE = ("latin-1", "cp1252", "iso8859-15", "cp1250", "iso8859-2", "cp1251", "koi8-r", "iso8859-5", "cp866", "mac-roman", "mac-cyrillic", "mac-latin2", "cp437", "cp850", "cp852", "cp1253", "cp1254", "iso8859-7")
#: Least different runs and least twin forms that a transformation must explain; how many times more files a restored word stands in.
LEAST_RUNS, LEAST_FORMS, TIMES = 3, 5, 4
#: Rows of a partition's local counts before they are handed on.
LOCAL_FORMS = 300_000
#: Blocks whose characters are taken over together: Latin-1, Latin Extended-A, Greek, Cyrillic, spaces and punctuation, currency, signs.
BLOCKS = ((0xA0, 0xFF), (0x100, 0x17F), (0x384, 0x3CE), (0x400, 0x45F), (0x490, 0x491), (0x2000, 0x2044), (0x20A0, 0x20BF), (0x2116, 0x2122))
_high = re.compile(r"[^\x00-\x7f]")
_lost = re.compile("[�\x80-\x84\x86-\x9f]")
_split_word = re.compile(r"[^\s\x00-\x26\x28-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_ascii_letters = re.compile("[A-Za-z]")
_bare = re.compile(r"(?<![^\s\x00-\x40\x5b-\x60\x7b-\x7f])[^\x00-\x7f]{3,}(?![^\s\x00-\x40\x5b-\x60\x7b-\x7f])")
_digits = re.compile("[0-9]+")
_cyrillic, _latin = re.compile("[\u0400-\u04ff]"), re.compile("[A-Za-z\u00c0-\u024f]")


def _encode(c: str, codec: str) -> bytes | None:
    """Bytes of a text; a C1 control stands for its own byte where the code page leaves it free."""
    try:
        return c.encode(codec)
    except UnicodeEncodeError:
        out = b""
        for x in c:
            try:
                out += x.encode(codec)
            except UnicodeEncodeError:
                if not 0x80 <= ord(x) <= 0x9F:
                    return None
                out += bytes([ord(x)])
        return out


@functools.lru_cache(maxsize=64)
def _page(codec: str) -> list[str]:
    """The character of each byte; a free byte is the control of its number, as lenient decoders have it."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def garble(text: str, change: str) -> str | None:
    """What becomes of text by the change "written>read"; None if the encoding can't write it."""
    wrote, read = change.split(">")
    raw = _encode(text, wrote)
    page = _page(read)
    return None if raw is None else "".join([page[b] for b in raw])


def restore(text: str, change: str) -> str | None:
    wrote, read = change.split(">")
    raw = _encode(text, read)
    if raw is None:
        return None
    try:
        return raw.decode(wrote)
    except UnicodeDecodeError:
        return None


#: Every transformation that is tried.
CHANGES = tuple(f"utf-8>{r}" for r in SINGLE) + tuple(f"{w}>{r}" for w in SINGLE for r in SINGLE if w != r)


def strange(word: str, line: str) -> bool:
    """Whether a short word mixes Latin and Cyrillic, or is Cyrillic in a line of mostly Latin letters: only then two letters say enough."""
    return bool(_cyrillic.search(word)) and (bool(_latin.search(word)) or len(_latin.findall(line)) > 3 * len(_cyrillic.findall(line)))


def skeleton(form: str) -> str:
    return _high.sub("", form)


def runs_of(form: str) -> list[tuple[int, str]]:
    """The runs of non-ASCII characters with their place in the skeleton."""
    out, at = [], 0
    for m in re.finditer(r"([^\x00-\x7f]+)|([\x00-\x7f]+)", form):
        if m.group(1):
            out.append((at, m.group(1)))
        else:
            at += len(m.group(2))
    return out


def explained(garbled: str, clean: str) -> list[tuple[str, str]]:
    """(change, clean run) for each aligned run that the change turns from clean to garbled; all runs that differ must be explained."""
    a, b = runs_of(garbled), runs_of(clean)
    if [x[0] for x in a] != [x[0] for x in b]:
        return []
    unlike = [(g, c) for (_, g), (_, c) in zip(a, b, strict=True) if g != c]
    return [(t, c) for t in CHANGES if unlike and all(garble(c, t) == g for g, c in unlike) for _, c in unlike]


def _forms(files: DataFrame) -> DataFrame:
    """scope, skeleton, form, files: distinct forms of words and of lines without ASCII letters in some word, with the files that hold them."""

    def run(batches):
        counts: dict = {}

        def part():
            keys = list(counts)
            return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(3)), pa.array(list(counts.values()), pa.int64())], names=["scope", "skeleton", "form", "files"])

        for batch in batches:
            for source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set()
                for w in set(_split_word.findall(text)):
                    if not w.isascii():
                        s = skeleton(w)
                        found.add(("w", s if len(_ascii_letters.findall(s)) > 1 else None, w))
                for line in set(text.split("\n")):
                    if not line.isascii() and _bare.search(line):
                        form = " ".join(_digits.sub("0", line).split(" "))
                        found.add(("l " + (source or ""), skeleton(form), form))
                for k in found:
                    counts[k] = counts.get(k, 0) + 1
            if len(counts) > LOCAL_FORMS:
                yield part()
                counts.clear()
        yield part()

    rows = files.filter(r"text RLIKE '[^\\x00-\\x7f]'").select("source", "text").mapInArrow(run, "scope string, skeleton string, form string, files long")
    return rows.groupBy("scope", "skeleton", "form").agg(F.sum("files").alias("files"))


def learn(forms: DataFrame) -> dict[str, set[str]]:
    """The learned changes with the clean characters each was seen on, from stored forms; bounded by CHANGES and by Unicode."""
    twins = forms.filter("skeleton IS NOT NULL")
    hubs = twins.groupBy("scope", "skeleton").agg(F.max_by("form", F.struct("files", "form")).alias("clean"), F.count("*").alias("n")).filter("n > 1")
    pairs = twins.join(hubs, ["scope", "skeleton"]).filter("form <> clean")

    def run(batches):
        for batch in batches:
            changes, runs = [], []
            for g, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for t, r in explained(g, c):
                    changes.append(t)
                    runs.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(changes, pa.string()), pa.array(runs, pa.string())], names=["change", "run"])

    # words without ASCII letters have no skeleton: their near-twins are words of as many letters, aligned one to one by a change
    bare = forms.filter(r"scope = 'w' AND length(form) >= 4 AND NOT form RLIKE '[A-Za-z]'").select("form", "files")
    turned = _tried(bare, list(CHANGES))
    sound = bare.select(F.col("form").alias("restored"), F.col("files").alias("of"))
    aligned = turned.join(sound, "restored").filter(F.col("of") >= F.col("files") * TIMES).select("change", F.col("restored").alias("run"), F.lit(True).alias("bare"))
    votes = stored(pairs.select("form", "clean").mapInArrow(run, "change string, run string").withColumn("bare", F.lit(False)).unionByName(aligned))
    support = {r["change"]: r for r in votes.groupBy("change").agg(F.count("*").alias("n"), F.countDistinct("run").alias("runs"), F.countDistinct(F.when(F.col("bare"), F.col("run"))).alias("bare")).collect()}
    learned: dict[str, set[str]] = {}
    for t, r in sorted(support.items()):
        wrote, read = t.split(">")
        back = support.get(f"{read}>{wrote}")
        # where the garbled form was the more frequent one, a change is seen backwards; the twins of bare words are told by many times more files
        if r["runs"] >= LEAST_RUNS and r["n"] >= LEAST_FORMS and (back is None or back["n"] < r["n"] or r["bare"] >= LEAST_RUNS):
            learned[t] = set()
    chars = votes.filter(F.col("change").isin(*learned)).select("change", F.explode(F.split("run", "")).alias("c")).filter("c <> ''").distinct()
    for r in chars.collect():
        learned[r["change"]].add(r["c"])
    return learned


class Repair:
    """Restores lines by a table from garbled sequences to characters."""

    def __init__(self, learned: dict[str, set[str]]):
        self.to: dict[str, str] = {}
        for t, seen in sorted(learned.items()):
            if not t.startswith("utf-8>"):
                continue
            # a block is taken over as a whole once several of its characters were seen garbled this way; Latin-1 and punctuation go together
            inventory = {c for c in seen if ord(c) > 0x9F}
            for a, b in BLOCKS:
                if sum(a <= ord(c) <= b for c in seen) >= 2 or (b == 0xFF or a == 0x2000) and any(0xA0 <= ord(c) <= 0xFF for c in seen):
                    inventory |= {chr(n) for n in range(a, b + 1) if U.category(chr(n)) not in ("Cn", "Cc")}
            for c in sorted(inventory):
                g = garble(c, t)
                if g and _high.search(g) and g != c:
                    self.to.setdefault(g, c)
        by = sorted(self.to, key=lambda g: (-len(g), g))
        firsts: dict[str, list[str]] = {}
        for g in by:
            firsts.setdefault(g[0], []).append(g[1:])
        self.find = re.compile("|".join(re.escape(f) + "(?:" + "|".join(map(re.escape, rest)) + ")" for f, rest in sorted(firsts.items()))) if by else None

    def line(self, text: str) -> tuple[str, bool]:
        """The restored line, and whether it held signs of wrong decoding.

        A Cyrillic capital before a quote, dash or ellipsis may end a word in capitals: alone in its line such a sequence is no sign."""
        bad = bool(_lost.search(text))
        if self.find:
            seen = self.find.findall(text)
            if len(seen) == 1 and len(seen[0]) == 2 and "\u0400" <= seen[0][0] < "\u0430" and seen[0][1] in "“”‘’–—…«»":
                return text, bad
            for _ in range(4 if seen else 0):
                new = self.find.sub(lambda m: self.to[m.group()], text)
                if new == text:
                    break
                text, bad = new, True
        return text, bad


@functools.lru_cache(maxsize=4)
def repair(learned: tuple[tuple[str, str], ...]) -> Repair:
    return Repair({t: set(chars) for t, chars in learned})


def _tried(words: DataFrame, changes: list[str]) -> DataFrame:
    """word, files, change, restored: what each change would have made each word (form, files) out of."""

    def run(batches):
        for batch in batches:
            out = []
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for t in changes:
                    r = restore(w, t)
                    if r and r != w and not r.isascii():
                        out.append((w, n, t, r))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], names=["word", "files", "change", "restored"])

    return words.select("form", "files").mapInArrow(run, "word string, files long, change string, restored string")


def _swapped_words(forms: DataFrame, learned: list[str]) -> DataFrame:
    """word, change: words that a change between single-byte encodings made out of a word of many more files. A stored table."""
    words = forms.filter("scope = 'w'")
    tried = _tried(words, [t for t in learned if not t.startswith("utf-8>")])
    sound = words.select(F.col("form").alias("restored"), F.col("files").alias("of"))
    return stored(tried.join(sound, "restored").filter(F.col("of") >= F.col("files") * TIMES).groupBy("word").agg(F.max_by("change", F.struct("of", "change")).alias("change")))


def find_garbled(files: DataFrame) -> DataFrame:
    """path, line_no, text, restored of every line that wrong decoding left its signs in."""
    files = files.select("source", "path", "text").filter(F.col("text").isNotNull() & (F.col("text") != ""))
    forms = stored(_forms(files))
    learned = learn(forms)
    swapped = _swapped_words(forms, list(learned))
    kit = tuple((t, "".join(sorted(chars))) for t, chars in sorted(learned.items()))
    high = files.filter(r"text RLIKE '[^\\x00-\\x7f]'")

    def run(batches):
        fix = repair(kit)
        for batch in batches:
            rows = []
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for n, line in enumerate(text.split("\n"), 1):
                    if line.isascii():
                        continue
                    new, bad = fix.line(line)
                    words = [] if bad else [w for w in _split_word.findall(line) if not w.isascii() and (len(w) > 2 or strange(w, line))]
                    if bad or words:
                        rows.append((path, n, line, new, bad, words))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "line_no", "text", "restored", "bad", "words"])

    seen = high.select("path", "text").mapInArrow(run, "path string, line_no int, text string, restored string, bad boolean, words array<string>")
    by_sequence = seen.filter("bad").select("path", "line_no", "text", "restored")
    # lines with a swapped word: the change that most of its words speak for restores the line
    hits = seen.filter("NOT bad").select("path", "line_no", "text", F.explode("words").alias("word")).join(small(swapped), "word")
    votes = hits.groupBy("path", "line_no", "text", "change").agg(F.count("*").alias("n"))
    best = votes.groupBy("path", "line_no", "text").agg(F.max_by("change", F.struct("n", "change")).alias("change"))

    def turn(batches):
        for batch in batches:
            new = [restore(t, c) or t for t, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new, pa.string())], names=["path", "line_no", "text", "restored"])

    by_word = best.mapInArrow(turn, "path string, line_no int, text string, restored string")
    return by_sequence.unionByName(by_word)


def p4_found(spark, d):
    return find_garbled(table(spark, d, "files")).select(F.col("path").alias("text_path"), "line_no")


def p4_lines(spark, d):
    """The affected lines with their original text where it can be had."""
    return find_garbled(table(spark, d, "files")).withColumnRenamed("path", "text_path")


QUERIES = {"p4_found": p4_found, "p4_lines": p4_lines}
