"""Near-duplicate texts: an exact set-similarity join by prefix filtering.

Runs of five words make a text's set. Texts of equal sets form a class and are represented by its smallest id, so copies never meet. For a
Jaccard of at least t two sets of sizes a <= b need a >= t b, and they share one of the rarest |x| - ceil(t |x|) + 1 elements of each, if
all sets are ordered by the same rarity. Only these prefixes are joined, with the filters of length and of position; what is left is
verified on the whole sets. No pair is lost and no element is left out for being frequent."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import text as X
from lexmill.scale import salted_lookup, small, stored

SIZE, LEAST = 5, 0.8
#: Holders of one element that a task pairs with all others of it.
PAIR_BLOCK = 500


def shingle_sets(docs: DataFrame, key: str, text: str = "text", size: int = SIZE) -> DataFrame:
    """key and the distinct hashed runs of words; texts without a whole run are left out."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    # each step is a column of its own: inside a lambda an expression is worked out again for every element
    split = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), words.alias("w")).filter(F.size("w") >= size)
    return split.select("key", F.array_sort(F.array_distinct(X.hashed_runs(F.col("w"), size))).alias("s"))


def classes(sets: DataFrame) -> DataFrame:
    """key and class: the smallest key of those with the same set."""
    marked = sets.select("key", F.struct(F.xxhash64("s"), F.hash("s"), F.size("s")).alias("h"))
    return salted_lookup(marked, stored(marked.groupBy("h").agg(F.min("key").alias("class"))), "h", spread=F.col("key")).select("key", "class")


def _met(left: DataFrame, right: DataFrame, held: DataFrame) -> DataFrame:
    """Rows x of left beside rows y of right (both key, e) of the same element; held: e and the holders it has in right.

    An element of n holders makes ceil(n / PAIR_BLOCK) blocks: each row of left is in one of them, each of right in all."""
    blocks = held.select("e", F.ceil(F.col("df") / PAIR_BLOCK).cast("int").alias("blocks"))
    x = salted_lookup(left, blocks, "e", spread=F.col("key")).withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    y = salted_lookup(right, blocks, "e", spread=F.col("key")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return x.alias("x").join(y.alias("y"), F.expr("x.e = y.e AND x.block = y.block"))


def similar_pairs(sets: DataFrame, least: float = LEAST) -> DataFrame:
    """a < b and their Jaccard, for class representatives."""
    n = F.size("s")
    sets = stored(sets)
    elements = sets.select("key", n.alias("n"), F.explode("s").alias("e"))
    rarity = stored(elements.groupBy("e").agg(F.count("*").alias("df")))
    # rarest first; the prefix that must meet another set's prefix
    ranked = salted_lookup(elements, rarity, "e", spread=F.col("key")).groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("o"))
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1
    prefix = stored(ranked.select("key", "n", F.posexplode(F.slice("o", 1, keep.cast("int"))).alias("p", "x")).select("key", "n", "p", "x.e"))
    held = stored(prefix.groupBy("e").agg(F.count("*").alias("df")).filter("df > 1"))
    meet = _met(prefix, prefix, held).filter("x.n < y.n OR (x.n = y.n AND x.key < y.key)")
    meet = meet.filter((F.col("x.n") >= F.col("y.n") * F.lit(least) - 1e-9))
    # at these places the two can share at most so many elements
    most = F.lit(1) + F.least(F.col("x.n") - F.col("x.p") - 1, F.col("y.n") - F.col("y.p") - 1)
    need = F.ceil((F.col("x.n") + F.col("y.n")) * F.lit(least / (1 + least)) - 1e-9)
    pairs = stored(meet.groupBy(F.col("x.key").alias("a"), F.col("y.key").alias("b")).agg(F.min(need).alias("need"), F.max(most + F.least("x.p", "y.p")).alias("most")).filter("most >= need").select("a", "b"))
    left = pairs.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    scored = left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (shared / (F.size("sa") + F.size("sb") - shared)).alias("jaccard"))
    return scored.filter(F.col("jaccard") >= least - 1e-12)


_ODD = (np.random.default_rng(64).integers(1, 1 << 63, 64, np.uint64) << np.uint64(1)) | np.uint64(1)


@F.pandas_udf(T.ArrayType(T.LongType()))
def minhash(hashes: pd.Series) -> pd.Series:
    """The least value of each of 64 seeded hashes of a set; the share of equal places of two signatures estimates their Jaccard."""

    def least(h):
        if h is None or not len(h):
            return None
        with np.errstate(over="ignore"):
            x = np.asarray(h, np.int64).view(np.uint64)[:, None] * _ODD[None, :]
            return (x ^ (x >> np.uint64(31))).min(axis=0).view(np.int64)

    return hashes.map(least)


#: A mark of a run within texts: the low bits of its hash.
MARK_BITS = 48
#: Marks that a part of all texts' marks holds on average at most; a task holds one part.
PART_MARKS = 2_000_000
_PLACES = (np.random.default_rng(5).integers(1, 1 << 63, SIZE, np.uint64) << np.uint64(1)) | np.uint64(1)


def squeezed(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key and s: the words of a text in lower case, one blank between them."""
    # no filter by the number of words, which would squeeze each text once more
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), words.alias("s"))


def _marks(column: pa.Array) -> np.ndarray:
    """Row << MARK_BITS | mark, sorted, for the distinct marks of each row; column: squeezed texts or sets of hashes, of less than 1 << 16 rows."""
    if pa.types.is_string(column.type):
        split = pc.split_pattern(column, " ")
        words = split.flatten().dictionary_encode()
        known = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words.dictionary.to_pylist()], np.uint64)
        w, counts = known[words.indices.to_numpy()], pc.list_value_length(split).to_numpy()
        with np.errstate(over="ignore"):
            h = sum(w[i : len(w) - SIZE + 1 + i] * _PLACES[i] for i in range(SIZE)) if len(w) >= SIZE else w[:0]
            h = (h ^ (h >> np.uint64(31))) * _PLACES[0]
            h ^= h >> np.uint64(29)
        row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        whole = row[: len(h)] == row[SIZE - 1 :]
        h, row = h[whole], row[: len(h)][whole]
    else:
        h = column.flatten().to_numpy().view(np.uint64)
        row = np.repeat(np.arange(len(column), dtype=np.uint64), pc.fill_null(pc.list_value_length(column), 0).to_numpy())
    u = np.sort(row << np.uint64(MARK_BITS) | h & np.uint64((1 << MARK_BITS) - 1))
    return u[np.concatenate([[True], u[1:] != u[:-1]])] if len(u) else u


def _slices(batches):
    """key and s of at most so many rows that a row's number fits beside its marks."""
    for b in batches:
        for at in range(0, b.num_rows, 1 << 15):
            part = b.slice(at, 1 << 15)
            yield part.column("key"), part.column("s")


def digests(sets: DataFrame) -> DataFrame:
    """key, n and h: the number of distinct runs and a digest of them, equal for equal sets."""

    def run(batches):
        for keys, s in _slices(batches):
            u = _marks(s)
            ends = np.searchsorted(u >> np.uint64(MARK_BITS), np.arange(len(keys), dtype=np.uint64), "right")
            starts, marks = np.concatenate([[0], ends[:-1]]), (u & np.uint64((1 << MARK_BITS) - 1)).tobytes()
            found = [hashlib.blake2b(marks[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([keys, pa.array((ends - starts).astype(np.int32)), pa.array(found, pa.binary())], ["key", "n", "h"])

    return sets.select("key", "s").mapInArrow(run, T.StructType([sets.schema["key"], T.StructField("n", T.IntegerType()), T.StructField("h", T.BinaryType())]))


def copies(marked: DataFrame) -> DataFrame:
    """Keys of a stored table of digests() whose set a smaller key has too."""
    first = stored(marked.groupBy("h").agg(F.min("key").alias("class"), F.count("*").alias("c")).filter("c > 1").select("h", "class"))
    return salted_lookup(marked, first, "h", spread=F.col("key")).filter("key <> class").select("key")


def _postings(sets: DataFrame, parts: int) -> DataFrame:
    """e, df, block, keys: the marks that several sets have, and who has them, at most PAIR_BLOCK keys in a row.

    Marks travel packed, eight bytes each, in parts by their value."""

    def pack(batches):
        for keys, s in _slices(batches):
            u = _marks(s)
            if not len(u):
                continue
            part = ((u & np.uint64((1 << MARK_BITS) - 1)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            u, part = u[order], part[order]
            row = u >> np.uint64(MARK_BITS)
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (row[1:] != row[:-1])])
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            # rows are numbered anew within each part
            rank = np.cumsum(new) - 1
            begin = rank[cuts]
            rank -= np.repeat(begin, np.diff(np.append(cuts, len(u))))
            packed = (rank.astype(np.uint64) << np.uint64(MARK_BITS) | u & np.uint64((1 << MARK_BITS) - 1)).tobytes()
            ends = np.append(cuts[1:], len(u))
            who = pa.ListArray.from_arrays(pa.array(np.append(begin, new.sum()).astype(np.int32)), keys.take(pa.array(row[new].astype(np.int64))))
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts]), who, pa.array([packed[8 * a : 8 * b] for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)], pa.binary())], ["part", "keys", "u"])

    def shared(t):
        who, u = pa.concat_arrays(t.column("keys").chunks), [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("u").combine_chunks()]
        before = np.concatenate([[0], np.cumsum(pc.list_value_length(who).to_numpy())[:-1]]).astype(np.uint64)
        holder = np.concatenate([(x >> np.uint64(MARK_BITS)) + b for x, b in zip(u, before, strict=True)])
        marks = np.concatenate(u) & np.uint64((1 << MARK_BITS) - 1)
        order = np.argsort(marks)
        marks = marks[order]
        same = marks[1:] == marks[:-1]
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        marks, holder = marks[keep], holder[order[keep]]
        starts = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]])[: len(marks)])
        df = np.diff(np.append(starts, len(marks)))
        blocks = -(-df // PAIR_BLOCK)
        block = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = np.append(np.repeat(starts, blocks) + block * PAIR_BLOCK, len(marks)).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(at), who.flatten().take(pa.array(holder.astype(np.int64))))
        return pa.Table.from_arrays([pa.array(np.repeat(marks[starts], blocks).astype(np.int64)), pa.array(np.repeat(df, blocks).astype(np.int32)), pa.array(block.astype(np.int32)), keys], ["e", "df", "block", "keys"])

    keys = T.StructField("keys", T.ArrayType(sets.schema["key"].dataType))
    packed = sets.select("key", "s").mapInArrow(pack, T.StructType([T.StructField("part", T.IntegerType()), keys, T.StructField("u", T.BinaryType())]))
    return packed.groupBy("part").applyInArrow(shared, T.StructType([T.StructField("e", T.LongType()), T.StructField("df", T.IntegerType()), T.StructField("block", T.IntegerType()), keys]))


def contained_pairs(sets: DataFrame, least: float = LEAST, sizes: DataFrame | None = None) -> DataFrame:
    """small, large, share: sets of which at least that share lies in another set that is no smaller, for class representatives.

    sets: key and s, sets of hashes or squeezed texts; sizes: a stored table with their key and n, if at hand.
    A set held to that share by another has that share of elements which others have too, and one of its rarest |s| - ceil(least |s|) + 1
    elements lies in the other: only these look for partners. Pairs found by marks are verified on the sets, which are made again for them only."""
    sizes = sizes if sizes is not None else stored(digests(sets))
    marks = sizes.agg(F.sum("n")).first()[0] or 0
    posts = stored(_postings(sets, max(2 * int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-marks // PART_MARKS))))
    n = sizes.select("key", "n")
    holders = posts.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("c"))
    lookers = stored(holders.join(n, "key").filter(F.col("c") >= F.ceil(F.col("n") * F.lit(least) - 1e-9)))
    ranked = posts.select("df", "e", F.explode("keys").alias("key")).join(small(lookers), "key").groupBy("key", "n", "c").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("o"))
    # elements that no other set has come first in the order, and take their part of the prefix
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1 - (F.col("n") - F.col("c"))
    prefix = stored(ranked.select("key", F.explode(F.slice("o", 1, keep.cast("int"))).alias("x")).select("key", "x.e", F.explode(F.sequence(F.lit(0), F.floor((F.col("x.df") - 1) / PAIR_BLOCK).cast("int"))).alias("block")))
    meet = posts.join(small(prefix), ["e", "block"]).select(F.col("key").alias("small"), F.explode("keys").alias("large")).filter("small <> large").distinct()
    of = lambda c: n.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"))
    pairs = stored(meet.join(of("small"), "small").join(of("large"), "large").filter("n_small < n_large OR (n_small = n_large AND small < large)").select("small", "large"))
    need = stored(pairs.select(F.explode(F.array("small", "large")).alias("key")).distinct())
    whole = sets.join(small(need), "key", "left_semi")
    if isinstance(sets.schema["s"].dataType, T.StringType):
        whole = whole.select("key", F.split("s", " ").alias("w")).select("key", F.array_distinct(X.hashed_runs(F.col("w"), SIZE)).alias("s"))
    whole = stored(whole)
    both = pairs.join(whole.select(F.col("key").alias("small"), F.col("s").alias("a")), "small").join(whole.select(F.col("key").alias("large"), F.col("s").alias("b")), "large")
    return both.select("small", "large", (F.size(F.array_intersect("a", "b")) / F.size("a")).alias("share")).filter(F.col("share") >= least - 1e-12)
