"""Long exact spans shared between records (problem 5).

Spans of whole sentences alone would miss passages that begin and end within sentences, so the method is carried out with spans of a
fixed number of words that begin at sentences: the ANCHORS of a text are runs of ANCHOR words that begin right behind the end of a
sentence, or, where no sentence ends within reach, at the place with the least hash. Of any SPAN consecutive words the choice among the
starts that leave room for an anchor depends on these words alone, so two texts that share SPAN words share an anchor within them.

1. Anchors are hashed and joined globally, as counts: only anchors of two or more records go on.
2. Around these, every run of SPAN words that holds the anchor is hashed (128 bits of two independent sums) and joined: runs of two or
   more records are the shared spans, exactly. A boilerplate line of 30 to 49 words drops out here without ever forming pairs.
3. Runs that stand in the same records are reduced to one of them by a signature of the records, before pairs are formed; a run of many
   records is paired in blocks of its records. All pairs are part of the required result.

Words are what white space of any kind separates. Defined results: null, empty and short texts share nothing; records of equal number
are one record; an empty table gives no rows; texts are taken whole; other columns are left out."""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.scale import small, stored, table

SPAN, ANCHOR = 50, 30
#: Records of one shared run that a task pairs with all others of the run.
PAIR_BLOCK = 500
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_end = re.compile("[.!?…][\"'”’»)\\]]*$")


class Words(dict):
    """64-bit hashes of words; the last bit tells whether a sentence ends with the word."""

    def __missing__(self, w: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = xxhash.xxh3_64_intdigest(w.encode()) & ~1 | bool(_end.search(w))
        self[w] = h
        return h


@functools.lru_cache(maxsize=1)
def _known() -> Words:
    return Words()


def hashes_of(text: str) -> np.ndarray:
    known = _known()
    return np.array([known[w] for w in text.split()], np.uint64)


@functools.lru_cache(maxsize=64)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    for i in range(1, size):
        out[i] = out[i - 1] * np.uint64(base)
    return out


def run_hashes(h: np.ndarray, size: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
    """A hash of every run of `size` words: differences of prefix sums of the words times powers of an odd base, times its inverse powers."""
    n = len(h)
    if n < size:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        powers = _grown(n, int(base))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:n], dtype=np.uint64)])
        raw = (sums[size:] - sums[:-size]) * _grown(n, _inverse(int(base)))[: n - size + 1]
        return (raw ^ (raw >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


@functools.lru_cache(maxsize=8)
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


_tables: dict[int, np.ndarray] = {}


def _grown(n: int, base: int) -> np.ndarray:
    have = _tables.get(base)
    if have is None or len(have) < n:
        have = _tables[base] = _powers(1 << max(12, n.bit_length()), base)
    return have


def anchor_starts(h: np.ndarray, span: int = SPAN, anchor: int = ANCHOR) -> np.ndarray:
    """Starts of the text's anchors: of each span the first choice among the starts 1 .. span - anchor, behind a sentence's end if any.

    Start i is judged by word i - 1 and word i, both within the span, so the choice is the same wherever the span stands; a text that is
    too short for a span has none."""
    n = len(h)
    if n < span:
        return np.zeros(0, np.int64)
    width = span - anchor
    with np.errstate(over="ignore"):
        key = (h[:-1] * np.uint64(0x9FB21C651E98DF25) ^ h[1:]) * np.uint64(0xFF51AFD7ED558CCD)
    # key[i - 1] belongs to start i; the top bit tells starts within sentences
    key = key >> np.uint64(1) | np.where(h[:-1] & np.uint64(1), np.uint64(0), np.uint64(1 << 63))
    views = np.lib.stride_tricks.sliding_window_view(key, width)[: n - span + 1]
    return np.unique(views.argmin(axis=1) + np.arange(len(views)) + 1)


def anchors(files: DataFrame, num: str = "num", text: str = "text") -> DataFrame:
    """num and hash of each anchor, once per row."""
    kind = files.schema[num].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = []
            for t in batch.column(1).to_pylist():
                h = hashes_of(t)
                lists.append(np.unique(run_hashes(h, ANCHOR)[anchor_starts(h)]).view(np.int64))
            ends = np.cumsum([0, *map(len, lists)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))], names=["num", "anchors"])

    rows = files.select(F.col(num).alias("num"), F.col(text).alias("text")).filter(F.length("text") >= 2 * SPAN - 1).mapInArrow(run, f"num {kind}, anchors array<long>")
    return rows.select("num", F.explode("anchors").alias("anchor"))


def shared_runs(files: DataFrame, num: str = "num", text: str = "text") -> DataFrame:
    """num, run (two halves of 128 bits), at (first word): every run of SPAN words around an anchor that two records have.

    The anchors that repeat are far fewer than all; those of a record travel to it as one array."""
    files = files.select(F.col(num).alias("num"), F.col(text).alias("text")).filter(F.col("num").isNotNull() & F.col("text").isNotNull())
    kind = files.schema["num"].dataType.simpleString()
    all_anchors = stored(anchors(files))
    repeated = all_anchors.groupBy("anchor").agg(F.min("num").alias("a"), F.max("num").alias("b")).filter("a < b").select("anchor")
    repeated = stored(repeated)
    wanted = stored(all_anchors.join(small(repeated), "anchor", "left_semi").groupBy("num").agg(F.collect_set("anchor").alias("anchors")))

    def run(batches):
        for batch in batches:
            ends, highs, lows, starts = [0], [], [], []
            for t, want in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                h = hashes_of(t)
                at = anchor_starts(h)
                at = at[np.isin(run_hashes(h, ANCHOR)[at].view(np.int64), np.array(want, np.int64))]
                # runs that hold the anchor with at least one word before it, as the choice of anchors demands
                first = (at[:, None] - np.arange(1, SPAN - ANCHOR + 1)[None, :]).ravel()
                first = np.unique(first[(first >= 0) & (first <= len(h) - SPAN)])
                starts.append(first.astype(np.int32))
                highs.append(run_hashes(h, SPAN, _BASES[0])[first].view(np.int64))
                lows.append(run_hashes(h, SPAN, _BASES[1])[first].view(np.int64))
                ends.append(ends[-1] + len(first))
            join = lambda xs, t: pa.array(np.concatenate(xs) if xs else np.zeros(0, t))
            runs = pa.StructArray.from_arrays([join(highs, np.int64), join(lows, np.int64), join(starts, np.int32)], names=["high", "low", "at"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)], names=["num", "runs"])

    found = files.join(small(wanted), "num").mapInArrow(run, f"num {kind}, runs array<struct<high:long,low:long,at:int>>")
    rows = stored(found.select("num", F.explode("runs").alias("r")).select("num", "r.high", "r.low", "r.at"))
    twice = rows.groupBy("high", "low").agg(F.min("num").alias("a"), F.max("num").alias("b")).filter("a < b").select("high", "low")
    return rows.join(twice, ["high", "low"])


def shared_pairs(files: DataFrame, num: str = "num", text: str = "text") -> DataFrame:
    """num_a < num_b of every two records that share SPAN consecutive words, once."""
    runs = stored(shared_runs(files, num, text).select("num", "high", "low").distinct())
    # the same records share many overlapping runs: one run for each set of records, told by its size and two hashes of its members
    sets = runs.groupBy("high", "low").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.col("num"))).alias("s"), F.bit_xor(F.xxhash64(F.col("num"), F.lit(1))).alias("t"))
    chosen = stored(sets.groupBy("n", "s", "t").agg(F.min(F.struct("high", "low")).alias("r")).select("n", "r.high", "r.low"))
    members = stored(runs.join(small(chosen), ["high", "low"]))
    # a run of n records makes ceil(n / PAIR_BLOCK) blocks: each record on the left in one of them, on the right in all
    blocks = F.ceil(F.col("n") / PAIR_BLOCK).cast("int")
    left = members.select("high", "low", F.col("num").alias("num_a"), F.pmod(F.xxhash64("num"), blocks).cast("int").alias("block"))
    right = members.select("high", "low", F.col("num").alias("num_b"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    return left.join(right, ["high", "low", "block"]).filter("num_a < num_b").select("num_a", "num_b").distinct()


def texts_of_docs(spark, d) -> DataFrame:
    """num and text of each distinct text of docs. A text under two paths is taken once: by the smallest path."""
    files = table(spark, d, "files").filter("doc IS NOT NULL AND text IS NOT NULL").select(F.col("doc").alias("num"), "path", "text")
    twice = stored(files.groupBy("num").agg(F.count("*").alias("c"), F.min("path").alias("first")).filter("c > 1").select("num", "first"))
    marks = small(twice)
    docs = small(stored(table(spark, d, "docs").select("num")))
    return files.join(marks, "num", "left").filter("first IS NULL OR path = first").select("num", "text").join(docs, "num", "left_semi")


def p5_found(spark, d):
    return shared_pairs(texts_of_docs(spark, d))


def shared_words(files: DataFrame, num: str = "num", text: str = "text") -> DataFrame:
    """For each record its words, those in a span that another record has, and those in a span whose first record is another."""
    files = files.select(F.col(num).alias("num"), F.col(text).alias("text")).filter("num IS NOT NULL")
    runs = stored(shared_runs(files))
    firsts = runs.groupBy("high", "low").agg(F.min("num").alias("first"))
    marks = runs.join(firsts, ["high", "low"]).groupBy("num").agg(F.collect_set(F.struct("at", (F.col("first") < F.col("num")).alias("later"))).alias("runs"))
    schema = T.StructType([T.StructField("num", files.schema["num"].dataType), *(T.StructField(c, T.IntegerType()) for c in ("words", "shared", "repeated")), T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            out = []
            for t, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pieces = re.findall(r"\S+\s*", t or "")
                n = len((t or "").split())
                one, two = np.zeros(n, bool), np.zeros(n, bool)
                for r in own or ():
                    one[r["at"] : r["at"] + SPAN] = True
                    if r["later"]:
                        two[r["at"] : r["at"] + SPAN] = True
                rest = t if not two.any() or len(pieces) != n else "".join(p for p, gone in zip(pieces, two, strict=True) if not gone)
                out.append((n, int(one.sum()), int(two.sum()), rest))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=["num", "words", "shared", "repeated", "text"])

    return files.join(marks, "num", "left").mapInArrow(run, schema)


def p5_shared(spark, d):
    """How much of each text stands elsewhere, beside the greatest matched_words of its paths in pairs."""
    shared = shared_words(texts_of_docs(spark, d)).drop("text")
    pairs = table(spark, d, "pairs").filter("matched_words IS NOT NULL")
    sides = pairs.select(F.explode(F.array("a.path", "b.path")).alias("path"), "matched_words").filter("path IS NOT NULL").groupBy("path").agg(F.max("matched_words").alias("matched_words"))
    files = table(spark, d, "files").select("path", F.col("doc").alias("num")).filter("num IS NOT NULL")
    matched = files.join(sides, "path").groupBy("num").agg(F.max("matched_words").alias("matched_words"))
    return shared.join(matched, "num", "left")


def p5_texts(spark, d):
    """Each text without the words of spans whose first record is another."""
    return shared_words(texts_of_docs(spark, d)).select("num", "text", "repeated")


QUERIES = {"p5_found": p5_found, "p5_shared": p5_shared, "p5_texts": p5_texts}
_WORDS = """
    WITH t AS (SELECT doc AS num, arg_min(text, path) AS text FROM files WHERE doc IS NOT NULL AND text IS NOT NULL AND doc IN (SELECT num FROM docs) GROUP BY doc),
    w AS (SELECT num, list_filter(regexp_split_to_array(text, '[\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}\\x{0b}]+'), lambda x: x <> '') AS w FROM t),
    g AS (SELECT DISTINCT num, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM w, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS i))
"""
SQL = {
    "p5_found": f"{_WORDS} SELECT DISTINCT a.num AS num_a, b.num AS num_b FROM g a JOIN g b ON a.h = b.h AND a.num < b.num",
    "p5_shared": f"""
    {_WORDS}, r AS (SELECT h, min(num) AS f FROM g GROUP BY h HAVING count(DISTINCT num) > 1),
    c AS (SELECT num, count(DISTINCT i + k) AS shared, count(DISTINCT CASE WHEN f < num THEN i + k END) AS repeated FROM g JOIN r USING (h), range(0, 50) x(k) GROUP BY num),
    p AS (SELECT unnest([a.path, b.path]) AS path, matched_words FROM pairs WHERE matched_words IS NOT NULL), m AS (SELECT doc AS num, max(matched_words) AS matched_words FROM files JOIN p USING (path) WHERE doc IS NOT NULL GROUP BY doc)
    SELECT num, len(w) AS words, coalesce(shared, 0) AS shared, coalesce(repeated, 0) AS repeated, matched_words FROM w LEFT JOIN c USING (num) LEFT JOIN m USING (num)
    """,
}
