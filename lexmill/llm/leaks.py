"""Evaluation texts leaking into training text (problem 3).

The held-out works are the items of a BM25 index whose terms are runs of five words of the consistent form, hashed to 64 bits. Items of equal
text are one item of the index; their keys are joined to what is found. Items are hashed, counted and packed into index parts by the executors: a
part holds about PART_WORDS words, as sorted arrays of terms, postings in order of items, blocks of postings with their greatest weight, and
the items' words. Document frequencies and lengths are those of all items, whatever the part. Parts are written to the shared folder; the driver
passes them on one at a time, so neither it nor a worker ever holds more than one.

Every training passage (windows that overlap by more than any run asked for) queries the index by block-max WAND and gets all items that
reach their threshold; a passage that holds any `least` consecutive words of an item must reach it, as the threshold of an item is at most the
least weight that any such run of it has. Each hit is then verified: passage and item must have a run of `least` words in common.

With one part the documents are read, cut and searched in one pass. With several parts the first pass keeps only documents of which some `least`
consecutive words might stand in any item, by a filter of one byte a term of all items, and these are searched in each part.

Defined results: null, empty and short texts leak nothing; items without a run of `least` words are found by nothing; an item that
leaks twice into a document gives one row, repeated items (key and text) too; repeated documents give rows each; empty tables give no rows;
texts are taken whole; a null key is a key."""

from __future__ import annotations

import bisect
import functools
import pickle
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.canonical import consistent
from lexmill.llm.shared_spans import run_hashes
from lexmill.scale import drop_stored, salted_lookup, stored, table

TERM, LEAST_RUN = 5, 15
PASSAGE = 120
BLOCK = 64
#: Words of held-out text in a part of the index, about 32 bytes of arrays each: what a worker holds at a time.
PART_WORDS = 4_000_000
#: Words of training text whose terms are looked up at once.
STRIDE = 500_000
K1, B = 1.2, 0.75
_apostrophes = re.compile("['’]")
_word = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits of the consistent form, in lower case, without apostrophes."""
    return _word.findall(_apostrophes.sub("", consistent(text).lower()))


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, w: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w.encode())
        return h


@functools.lru_cache(maxsize=1)
def _known() -> _Hashes:
    return _Hashes()


def hashed_words(text: str) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(_known().__getitem__, words), np.uint64, len(words))


def pack(items: list[int], words: list[np.ndarray], common: dict[int, int], total: int, mean: float, least: int) -> dict[str, np.ndarray]:
    """The arrays of an index part. common: terms of more than one item of the whole index, with their number of items; total and mean: the
    number of all items and the mean of their numbers of terms."""
    size = least - TERM + 1
    runs = [run_hashes(w, TERM) for w in words]
    lengths = np.array([len(r) for r in runs], np.int64)
    terms = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(runs), dtype=np.int32), lengths)
    order = np.lexsort((owner, terms))
    t, o = terms[order], owner[order]
    opens = np.ones(len(t), bool)
    opens[1:] = (t[1:] != t[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(opens)
    times = np.diff(np.append(at, len(t)))
    post_term, post_item = t[at], o[at]
    first = np.ones(len(post_term), bool)
    first[1:] = post_term[1:] != post_term[:-1]
    begins = np.flatnonzero(first)
    own_terms = post_term[begins]
    have = np.ones(len(own_terms))
    if common and len(own_terms):
        keys = np.fromiter(common.keys(), np.uint64, len(common))
        place = np.minimum(np.searchsorted(own_terms, keys), len(own_terms) - 1)
        hit = own_terms[place] == keys
        have[place[hit]] = np.fromiter(common.values(), np.float64, len(common))[hit]
    ends = np.append(begins, len(post_term))
    df = np.repeat(have, np.diff(ends))
    weight = np.log(1 + (total - df + 0.5) / (df + 0.5)) * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[post_item] / max(mean, 1e-9)))
    weight = weight.astype(np.float32)
    blocks = -(-np.diff(ends) // BLOCK)
    block_ends = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
    block_at = np.repeat(begins, blocks) + BLOCK * (np.arange(block_ends[-1]) - np.repeat(block_ends[:-1], blocks))
    # the least weight of any run of `least` words, in which a term counts once: one that came within the run before counts nothing
    by_place = np.zeros(len(t))
    by_place[order] = weight[np.cumsum(opens) - 1]
    again = np.flatnonzero(~opens)
    near = again[order[again] - order[again - 1] < size]
    by_place[order[near]] = 0
    sums = np.concatenate([[0.0], np.cumsum(by_place)])
    whole = np.full(len(t), np.inf)
    n = max(0, len(t) - size + 1)
    whole[:n] = (sums[size:] - sums[:-size])[:n] if n else 0
    stop = np.cumsum(lengths)
    for k in range(1, size):  # windows that run over an item's end
        whole[np.maximum(stop - k, 0)] = np.inf
    least_sum = np.minimum.reduceat(whole, stop - lengths) - 1e-6 if len(runs) else np.zeros(0)
    return {
        "item": np.array(items, np.int64), "words": np.concatenate(words) if words else np.zeros(0, np.uint64), "word_ends": np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64),
        "terms": own_terms, "ends": ends, "post_item": post_item, "post_weight": weight, "most": np.maximum.reduceat(weight, begins) if len(begins) else weight,
        "block_ends": block_ends, "block_most": np.maximum.reduceat(weight, block_at) if len(block_at) else weight, "block_last": post_item[np.minimum(block_at + BLOCK, np.repeat(ends[1:], blocks)) - 1], "threshold": least_sum,
    }


class Index:
    """A part of the index: postings of items by term, in blocks with their greatest weight."""

    def __init__(self, arrays: dict[str, np.ndarray], least: int = LEAST_RUN):
        self.a, self.least = arrays, least
        self.lowest = float(arrays["threshold"].min()) if len(arrays["threshold"]) else np.inf
        self.runs: dict[int, np.ndarray] = {}

    def places(self, runs: np.ndarray) -> np.ndarray:
        """For each run of a text its number among the terms, -1 if it is none."""
        terms = self.a["terms"]
        if not len(terms):
            return np.full(len(runs), -1)
        at = np.minimum(np.searchsorted(terms, runs), len(terms) - 1)
        return np.where(terms[at] == runs, at, -1)

    def search(self, terms: list[int]) -> list[int]:
        """All items whose score for these distinct terms (by number) reaches their threshold, by block-max WAND.

        A cursor runs over each term's postings. The pivot is the first item that the sum of the terms' greatest weights could
        lift to the lowest threshold; if the weights of the blocks around it can't, the cursors leap behind the nearest block's end."""
        a, threshold = self.a, self.a["threshold"]
        most = a["most"][terms]
        if most.sum(dtype=np.float64) < self.lowest:
            return []
        most = most.tolist()
        span = lambda name, ends, n: a[name][a[ends][n] : a[ends][n + 1]].tolist()
        lists = [(span("post_item", "ends", n), span("post_weight", "ends", n), span("block_last", "block_ends", n), span("block_most", "block_ends", n)) for n in terms]
        at = [0] * len(lists)
        found: list[int] = []
        while True:
            live = sorted((x for x in range(len(lists)) if at[x] < len(lists[x][0])), key=lambda x: lists[x][0][at[x]])
            total, pivot = 0.0, None
            for n, x in enumerate(live):
                total += most[x]
                if total >= self.lowest:
                    pivot = n
                    break
            if pivot is None:
                return found
            item = lists[live[pivot]][0][at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == item:
                pivot += 1
            over, ends = 0.0, []
            for x in live[: pivot + 1]:
                k = bisect.bisect_left(lists[x][2], item)
                if k < len(lists[x][2]):
                    over += lists[x][3][k]
                    ends.append(lists[x][2][k])
            if over < self.lowest:
                to = min(ends, default=item) + 1
                if pivot + 1 < len(live):
                    to = min(to, lists[live[pivot + 1]][0][at[live[pivot + 1]]])
                to = max(to, item + 1)
                for x in live[: pivot + 1]:
                    at[x] = bisect.bisect_left(lists[x][0], to, at[x])
                continue
            if lists[live[0]][0][at[live[0]]] == item:
                score = 0.0
                for x in live[: pivot + 1]:
                    score += lists[x][1][at[x]]
                    at[x] += 1
                if score >= threshold[item]:
                    found.append(item)
            else:
                for x in live[:pivot]:
                    at[x] = bisect.bisect_left(lists[x][0], item, at[x])

    def runs_of(self, item: int) -> np.ndarray:
        """The sorted hashes of the item's runs of `least` words."""
        if item not in self.runs:
            if len(self.runs) > 1000:
                self.runs.clear()
            self.runs[item] = np.sort(run_hashes(self.a["words"][self.a["word_ends"][item] : self.a["word_ends"][item + 1]], self.least))
        return self.runs[item]

    def holds(self, item: int, runs: np.ndarray) -> bool:
        own = self.runs_of(item)
        return bool((own[np.minimum(np.searchsorted(own, runs), len(own) - 1)] == runs).any())

    def leaks_of(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The number of a text and an item of which it holds at least `least` consecutive words, for all texts, given as hashed words.

        Terms are looked up for all texts at once. Passages of which even the sum of their terms' greatest weights, repeated ones included,
        lies below the lowest threshold are told in one go; all others are searched."""
        flat = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
        lengths = np.array([len(t) for t in texts], np.int64)
        stops = np.cumsum(lengths)
        places = self.places(run_hashes(flat, TERM))
        for k in range(1, TERM):  # runs over the end of a text
            at = stops - k
            places[at[(at >= 0) & (at < len(places))]] = -1
        step = PASSAGE - self.least + 1
        passages = np.where(lengths >= self.least, (lengths - self.least) // step + 1, 0)
        of = np.repeat(np.arange(len(texts)), passages)
        starts = (stops - lengths)[of] + step * (np.arange(len(of)) - np.repeat(np.cumsum(passages) - passages, passages))
        ends = np.minimum(starts + PASSAGE, stops[of])
        where = np.flatnonzero(places >= 0)
        sums = np.concatenate([[0.0], np.cumsum(self.a["most"][places[where]], dtype=np.float64)])
        first, last = np.searchsorted(where, starts), np.searchsorted(where, np.maximum(ends - TERM + 1, starts))
        found: set[tuple[int, int]] = set()
        for n in np.flatnonzero(sums[last] - sums[first] >= self.lowest - 1e-6).tolist():
            items = self.search(np.unique(places[where[first[n] : last[n]]]).tolist())
            if items:
                full = run_hashes(flat[starts[n] : ends[n]], self.least)
                found.update((int(of[n]), item) for item in items if (int(of[n]), item) not in found and self.holds(item, full))
        rows = np.array(sorted(found), np.int64).reshape(-1, 2)
        return rows[:, 0], self.a["item"][rows[:, 1]]


def _hashed(df: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """The key and the hashed words of every text that has enough."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = [hashed_words(t) if t else np.zeros(0, np.uint64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)])
            flat = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=[key, "words"])

    return df.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"{key} {kind}, words array<long>").filter(F.size("words") >= least)


def index_parts(texts: DataFrame, least: int = LEAST_RUN, part_words: int = PART_WORDS) -> DataFrame:
    """A stored table of part and index, from a stored table of item and words (hashed)."""
    total, words = texts.agg(F.count("*"), F.sum(F.size("words"))).first()
    parts = max(1, -(-(words or 0) // part_words))
    mean = ((words or 0) - (TERM - 1) * total) / max(1, total)
    placed = texts.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int"))

    def terms(batches):
        for batch in batches:
            lists = [np.unique(run_hashes(np.asarray(w, np.int64).view(np.uint64), TERM)).view(np.int64) for w in batch.column(1).to_pylist()]
            sizes = [len(x) for x in lists]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes).astype(np.int32)), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))], names=["part", "term"])

    # a term's items are added up by part before the shuffle; terms of one item have a frequency of 1 and aren't carried
    seen = placed.select("part", "words").mapInArrow(terms, "part int, term long").groupBy("term", "part").agg(F.count("*").alias("n"))
    common = seen.groupBy("term").agg(F.sum("n").alias("n"), F.collect_list("part").alias("parts")).filter("n > 1").select("term", "n", F.explode("parts").alias("part"))

    def build(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        words = [np.asarray(w, np.int64).view(np.uint64) for w in left["words"]]
        frequent = dict(zip(right["term"].to_numpy(np.int64).view(np.uint64).tolist(), right["n"].tolist(), strict=True))
        return pd.DataFrame({"part": [key[0]], "index": [pickle.dumps(pack(left["item"].tolist(), words, frequent, total, mean, least), 5)]})

    return stored(placed.groupBy("part").cogroup(common.groupBy("part")).applyInPandas(build, "part int, index binary"))


def _filter_of(texts: DataFrame, words: int):
    """The bits of all items' terms, one byte a term, made of the bits of the table's partitions."""
    bits = max(1 << 16, 1 << (8 * words - 1).bit_length())

    def run(batches):
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for w in batch.column(0).to_pylist():
                at = (run_hashes(np.asarray(w, np.int64).view(np.uint64), TERM) & np.uint64(bits - 1)).astype(np.int64)
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], names=["bits"])

    whole = np.zeros(bits // 8, np.uint8)
    for r in texts.select("words").coalesce(4).mapInArrow(run, "bits binary").toLocalIterator():
        whole |= np.frombuffer(r.bits, np.uint8)
    return whole


def _maybe(docs: DataFrame, bits: np.ndarray, least: int) -> DataFrame:
    """Of stored (_doc, words) those with `least` consecutive words whose terms are all in the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    size = least - TERM + 1

    def run(batches):
        mine = shared.value
        mask = np.uint64(len(mine) * 8 - 1)
        for batch in batches:
            keep = []
            for w in batch.column(1).to_pylist():
                at = (run_hashes(np.asarray(w, np.int64).view(np.uint64), TERM) & mask).astype(np.int64)
                sums = np.concatenate([[0], np.cumsum((mine[at >> 3] >> (at & 7).astype(np.uint8)) & 1, dtype=np.int64)])
                keep.append(bool((sums[size:] - sums[:-size] == size).any()))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_held: dict[tuple[bytes, int], Index] = {}


def _found(docs: DataFrame, index: bytes, least: int) -> DataFrame:
    """item and _doc of what leaks from a part of the index. docs: _doc and words (hashed) or text."""
    mark = xxhash.xxh3_128_digest(index)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.loads(index))
    kind = docs.schema["_doc"].dataType.simpleString()
    as_text = docs.columns[1] != "words"

    def run(batches):
        if (mark, least) not in _held:
            _held.clear()
            _held[mark, least] = Index(shared.value, least)
        own, none = _held[mark, least], np.zeros(0, np.uint64)
        for batch in batches:
            texts = [none if not t else hashed_words(t) if as_text else np.asarray(t, np.int64).view(np.uint64) for t in batch.column(1).to_pylist()]
            begin = size = 0
            for n, t in enumerate(texts, 1):
                size += len(t)
                if size >= STRIDE or n == len(texts):
                    rows, items = own.leaks_of(texts[begin:n])
                    yield pa.RecordBatch.from_arrays([pa.array(items), batch.column(0).take(pa.array(rows + begin))], names=["item", "_doc"])
                    begin, size = n, 0

    return docs.mapInArrow(run, f"item long, _doc {kind}")


def leaked_items(docs: DataFrame, items: DataFrame, doc: str = "doc_id", key: str = "key", text: str = "text", least: int = LEAST_RUN, part_words: int = PART_WORDS) -> DataFrame:
    """key and doc: each document that holds at least `least` consecutive words of an item. items is the held-out set."""
    held = items.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(key).cast("string").alias("_key"), F.col(text).cast("string").alias("_text"))
    seed = 0
    while True:
        named = held.select(F.xxhash64(F.lit(seed), "_text").alias("item"), "_key", "_text")
        classes = stored(named.groupBy("item").agg(F.min("_text").alias("_text"), (F.min("_text") != F.max("_text")).alias("clash")))
        if classes.filter("clash").isEmpty():
            break
        drop_stored(classes)
        seed += 1
    names = stored(named.select("item", "_key").distinct())
    texts = stored(_hashed(classes, "item", "_text", least))
    parts = index_parts(texts, least, part_words)
    numbers = [r.part for r in parts.select("part").orderBy("part").collect()]
    rows = docs.select(F.col(doc).alias("_doc"), F.col(text).cast("string").alias("_text"))
    if len(numbers) > 1:
        bits = _filter_of(texts, texts.agg(F.sum(F.size("words"))).first()[0])
        rows = stored(_maybe(_hashed(rows, "_doc", "_text", least), bits, least))
    found = None
    for n in numbers:
        one = _found(rows, bytes(parts.filter(F.col("part") == n).select("index").first()[0]), least)
        found = one if found is None else found.union(one)
    drop_stored(parts)
    if found is None:
        found = rows.select(F.lit(0).cast("long").alias("item"), "_doc").limit(0)
    return salted_lookup(found, names, "item", spread=F.col("_doc")).select(F.col("_key").alias(key), F.col("_doc").alias(doc))


def p3_found(spark, d):
    # a key is unique among works; if it weren't, its items would be told apart by nothing, so equal rows are one case
    return leaked_items(table(spark, d, "documents"), table(spark, d, "works").filter("split = 'heldout'"))


def p3_items(spark, d):
    """For each held-out work, how many documents it leaked into."""
    works = table(spark, d, "works").filter("split = 'heldout'").select("key", "shelf", "title")
    n = p3_found(spark, d).groupBy("key").agg(F.count("*").alias("documents"))
    return works.join(n, "key", "left").withColumn("documents", F.coalesce("documents", F.lit(0)))


QUERIES = {"p3_found": p3_found, "p3_items": p3_items}
