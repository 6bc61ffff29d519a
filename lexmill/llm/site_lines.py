"""Lines repeated across one site's documents (problem 1).

Lines are parsed into templates through a token tree of fixed depth: source, number of tokens, then the first DEPTH tokens, where a token
with digits is a wildcard; the path to a leaf travels as a digest. In its leaf a line joins the template with the most equal tokens if at
least SIMILAR of them are equal, and the tokens that differ become wildcard slots; else it begins a template of its own. Every partition
grows its own trees, counting a file once per template, and hands them on in parts of bounded size; the trees of all partitions are merged
by joining similar templates of a leaf, and any two that one line could fit, so that a line has one template.

The tree decides which lines are counted: a leaf, then a template, that stands in too few files of its source holds no repeated line. Within
a template the lines that fill its slots alike are the same line, and those that stand in enough files are removed from each text. Leaves and
templates only ever count too many files, so which lines are found depends neither on the order of the lines nor on SIMILAR.

Leaves, templates and lines that cover a share s of their source's files number at most (lines per file) / s for each source, so the tables
that mark the lines are bounded; their size is checked before they are broadcast all the same.

Defined results: null and empty texts have no lines and aren't counted as files of the source, texts of white space are; a file that
stands twice in the table counts each time; a null source is a source of its own; an empty table gives no rows; there is no limit on
the length of lines or texts; columns other than source, path and text are left out."""

from __future__ import annotations

import itertools
import operator
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.scale import small, stored, table

DEPTH = 3
SIMILAR = 0.5
#: A leaf with so many templates is full: a line then joins its most similar template, however few tokens are equal. That template gets more slots; no line is lost.
LEAF_TEMPLATES = 64
#: A partition's trees are handed on when they hold so many different lines.
TREE_LINES = 500_000
LEAST_FILES, LEAST_SHARE, LEAST_WORDS = 5, 0.02, 3
_digits = re.compile("[0-9]+")
_word = re.compile(r"[^\W\d_]+")


def template_of(line: str, least_words: int = LEAST_WORDS) -> list[str] | None:
    """The line's tokens after lower-casing, letter by letter, with 0 for each run of digits; None if it has fewer runs of letters than asked."""
    if not line or line.isspace():
        return None
    words = 0
    for m in _word.finditer(line):
        w = m.group()
        # signs such as ² and Ⅷ are neither letters nor digits
        words += 1 if w.isalpha() else sum(k for k, _ in itertools.groupby(w, str.isalpha))
        if words >= least_words:
            if not line.isascii():
                line = line.replace("İ", "i").replace("Σ", "σ")
            return _digits.sub("0", line.lower()).split()
    return None


def digest(tokens: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(tokens).encode())


def leaf_of(tokens: list[str]) -> bytes:
    """The leaf that tokens lead to: their number and the first DEPTH of them, those with digits as wildcards."""
    return digest([str(len(tokens)), *("*" if "0" in t else t for t in tokens[:DEPTH])])


def place(templates: list[list], tokens: list) -> int:
    """The number of the template of a leaf that takes tokens, a new one if none is similar; its tokens that differ become slots (None)."""
    best, most = 0, -1
    for i, t in enumerate(templates):
        n = sum(map(operator.eq, t, tokens))
        if n > most:
            best, most = i, n
    if not templates or (most < SIMILAR * len(tokens) and len(templates) < LEAF_TEMPLATES):
        templates.append(list(tokens))
        return len(templates) - 1
    if most < len(tokens):
        templates[best] = _joined(templates[best], tokens)
    return best


def _joined(a: list, b: list) -> list:
    return [x if x == y else None for x, y in zip(a, b, strict=True)]


def merge(found: list[tuple[list, int]]) -> list[tuple[list, int]]:
    """One leaf's templates of all partitions with their files: similar ones are joined, then any two that one line could fit."""
    templates: list[list] = []
    files: list[int] = []
    for tokens, n in sorted(found, key=lambda x: (-x[1], [t or "" for t in x[0]])):
        i = place(templates, tokens)
        files[i : i + 1] = [files[i] + n if i < len(files) else n]
    again = True
    while again:
        again = False
        for i in range(len(templates)):
            for j in range(len(templates) - 1, i, -1):
                if i < j < len(templates) and all(x == y or x is None or y is None for x, y in zip(templates[i], templates[j], strict=True)):
                    templates[i] = _joined(templates[i], templates.pop(j))
                    files[i] += files.pop(j)
                    again = True
    return list(zip(templates, files, strict=True))


class Trees:
    """Token trees of a partition: source and leaf -> its templates, the files of each, and the template that took each line."""

    def __init__(self):
        self.leaves: dict = {}
        self.size = 0

    def add(self, source: str | None, lines: dict[bytes, tuple[bytes, list[str]]]) -> None:
        """The distinct lines of one file, each with its leaf and tokens."""
        hit = set()
        for key, (leaf, tokens) in lines.items():
            templates, files, taken = self.leaves.setdefault((source, leaf), ([], [], {}))
            i = taken.get(key)
            if i is None:
                i = taken[key] = place(templates, tokens)
                self.size += 1
                if i == len(files):
                    files.append(0)
            hit.add((leaf, i))
        for leaf, i in hit:
            self.leaves[source, leaf][1][i] += 1

    def emit(self):
        """Columns of all templates; the trees are empty afterwards."""
        sources, leaves, templates, files = [], [], [], []
        for (source, leaf), (found, n, _) in self.leaves.items():
            sources += [source] * len(found)
            leaves += [leaf] * len(found)
            templates += found
            files += n
        self.leaves, self.size = {}, 0
        return sources, leaves, templates, files


def _leaves(df: DataFrame, least_words: int) -> DataFrame:
    """Source, leaf and files: how many files of the source have a line that leads there."""

    def run(batches):
        seen: dict = {}

        def part():
            b = pa.RecordBatch.from_arrays([pa.array([s for s, _ in seen], pa.string()), pa.array([k for _, k in seen], pa.binary()), pa.array(seen.values(), pa.int64())], names=["source", "leaf", "files"])
            seen.clear()
            return b

        for batch in batches:
            for source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for leaf in {leaf_of(tokens) for line in set(text.split("\n")) if (tokens := template_of(line, least_words))}:
                    seen[source, leaf] = seen.get((source, leaf), 0) + 1
            if len(seen) >= TREE_LINES:
                yield part()
        yield part()

    # a hot leaf is one row per partition here, and digests spread a hot source
    return df.select("source", "text").mapInArrow(run, "source string, leaf binary, files long").groupBy("source", "leaf").agg(F.sum("files").alias("files"))


def _lines(df: DataFrame, least_words: int) -> DataFrame:
    """Every line that has tokens: source, path, line number, file (a number of its row), leaf, digest (template), and the tokens where it stands in the file first."""

    def run(batches):
        for batch in batches:
            ends, numbers, leaves, keys, firsts = [0], [], [], [], []
            for text in batch.column(3).to_pylist():
                leaf_by_key: dict = {}
                for n, line in enumerate(text.split("\n"), 1):
                    tokens = template_of(line, least_words)
                    if tokens:
                        joined = " ".join(tokens)
                        key = xxhash.xxh3_128_digest(joined.encode())
                        leaf = leaf_by_key.get(key)
                        firsts.append(joined if leaf is None else None)
                        if leaf is None:
                            leaf = leaf_by_key[key] = leaf_of(tokens)
                        numbers.append(n)
                        leaves.append(leaf)
                        keys.append(key)
                ends.append(len(numbers))
            lines = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(leaves, pa.binary()), pa.array(keys, pa.binary()), pa.array(firsts, pa.string())], names=["line_no", "leaf", "template", "tokens"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)], names=["source", "path", "file", "lines"])

    kind = "source string, path string, file long, lines array<struct<line_no:int,leaf:binary,template:binary,tokens:string>>"
    rows = df.select("source", "path", F.monotonically_increasing_id().alias("file"), "text").mapInArrow(run, kind)
    return rows.select("source", "path", "file", F.explode("lines").alias("l")).select("source", "path", "file", "l.*")


def _templates(lines: DataFrame) -> DataFrame:
    """Source, leaf, template and files of the trees of all partitions, merged."""

    def grow(batches):
        trees = Trees()

        def part():
            s, k, t, n = trees.emit()
            return pa.RecordBatch.from_arrays([pa.array(s, pa.string()), pa.array(k, pa.binary()), pa.array(t, pa.list_(pa.string())), pa.array(n, pa.int64())], names=["source", "leaf", "template", "files"])

        for batch in batches:
            # a file cut by two batches counts twice in a template, which may only leave it more lines to count
            for (_, source), rows in itertools.groupby(zip(*(c.to_pylist() for c in batch.columns), strict=True), operator.itemgetter(0, 1)):
                trees.add(source, {key: (leaf, tokens.split(" ")) for _, _, leaf, key, tokens in rows})
            if trees.size >= TREE_LINES:
                yield part()
        yield part()

    def join(batches):
        for batch in batches:
            s, k, t, n = [], [], [], []
            for source, leaf, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for template, files in merge([(f["template"], f["files"]) for f in found]):
                    s.append(source)
                    k.append(leaf)
                    t.append(template)
                    n.append(files)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.string()), pa.array(k, pa.binary()), pa.array(t, pa.list_(pa.string())), pa.array(n, pa.int64())], names=["source", "leaf", "template", "files"])

    kind = "source string, leaf binary, template array<string>, files long"
    grown = lines.filter("tokens IS NOT NULL").select("file", "source", "leaf", "template", "tokens").mapInArrow(grow, kind)
    # a leaf has at most LEAF_TEMPLATES rows for each part that a partition handed on
    return grown.groupBy("source", "leaf").agg(F.collect_list(F.struct("template", "files")).alias("found")).mapInArrow(join, kind)


def _in_leaf(lines: DataFrame, found: DataFrame, *more):
    """lines joined to the rows of found of their source and leaf."""
    on = lines["source"].eqNullSafe(found["source"]) & (lines["leaf"] == found["leaf"])
    for m in more:
        on &= m
    return lines.join(found, on)


def site_templates(files: DataFrame, least_files: int = LEAST_FILES, least_share: float = LEAST_SHARE, least_words: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored tables: the lines of the leaves that stand in enough files, as _lines gives them; the templates in enough files: source, leaf,
    template (tokens, null for a slot), files, of (files of the source); and the lines to remove: source, template (digest), files, of."""
    files = files.filter("text IS NOT NULL AND text <> ''")
    totals = small(stored(files.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("of"))))

    def enough(counted):
        covered = counted.filter(F.col("files") >= least_files).join(totals, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        return stored(covered.filter(F.col("files") >= F.col("of") * F.lit(float(least_share)) - 1e-9))

    leaves = small(enough(_leaves(files, least_words)).select("source", "leaf"))
    every = _lines(files, least_words)
    lines = stored(_in_leaf(every, leaves).select(*[every[c] for c in every.columns]))
    templates = enough(_templates(lines))
    slots = small(templates.select("source", "leaf", F.col("template").alias("_slots")))
    firsts = lines.filter("tokens IS NOT NULL").select("source", "leaf", "template", F.split("tokens", " ").alias("_tokens"))
    fits = F.forall(F.zip_with("_tokens", "_slots", lambda t, s: s.isNull() | (t == s)), lambda x: x)
    # a line fits one template of its leaf at most
    kept = _in_leaf(firsts, slots, fits).select(firsts["source"], "template")
    return lines, templates, enough(kept.groupBy("source", "template").agg(F.count("*").alias("files")))


def repeated_lines(files: DataFrame, **limits) -> DataFrame:
    """source, path, line_no, template: every occurrence of a line that covers enough files of its source."""
    lines, _, found = site_templates(files, **limits)
    marks = small(found.select(F.col("source").alias("_s"), F.col("template").alias("_t")))
    return lines.select("source", "path", "line_no", "template").join(marks, F.col("source").eqNullSafe(F.col("_s")) & (F.col("template") == F.col("_t"))).drop("_s", "_t")


def without_repeated_lines(files: DataFrame, **limits) -> DataFrame:
    """path, text without the repeated lines, and the number removed; the other lines stay as they are."""
    out = repeated_lines(files, **limits).groupBy("path").agg(F.collect_set("line_no").alias("_out"))

    def run(batches):
        for batch in batches:
            texts, removed = [], []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if text and gone:
                    drop = set(gone)
                    text = "\n".join(line for n, line in enumerate(text.split("\n"), 1) if n not in drop)
                texts.append(text)
                removed.append(len(gone or ()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int32())], names=["path", "text", "removed"])

    return files.select("path", "text").join(out, "path", "left").mapInArrow(run, "path string, text string, removed int")


def p1_found(spark, d):
    return repeated_lines(table(spark, d, "files")).select(F.col("path").alias("text_path"), "line_no")


def p1_texts(spark, d):
    """Each text at a jobs.text_path without its site's lines."""
    paths = table(spark, d, "jobs").select(F.col("text_path").alias("path")).filter("path IS NOT NULL").distinct()
    return without_repeated_lines(table(spark, d, "files")).join(paths, "path", "left_semi").withColumnRenamed("path", "text_path")


def p1_templates(spark, d):
    """How far each repeated line covers its source, with one of its forms."""
    found = repeated_lines(table(spark, d, "files"))
    return found.groupBy("source", F.hex("template").alias("template")).agg(F.count("*").alias("lines"), F.countDistinct("path").alias("files"))


QUERIES = {"p1_found": p1_found, "p1_texts": p1_texts, "p1_templates": p1_templates}
SQL = {
    "p1_found": """
    WITH f AS (SELECT source, path, text FROM files WHERE text <> ''),
    l AS (SELECT source, path, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM f),
    n AS (SELECT source, path, line_no, trim(regexp_replace(regexp_replace(lower(line), '[\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}\\x{0b}]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS k FROM l WHERE len(regexp_extract_all(line, '[\\p{L}]+')) >= 3),
    c AS (SELECT source, k, count(DISTINCT path) AS files FROM n GROUP BY source, k),
    t AS (SELECT source, count(*) AS total FROM f GROUP BY source)
    SELECT n.path AS text_path, CAST(n.line_no AS INTEGER) AS line_no FROM n JOIN c USING (source, k) JOIN t USING (source) WHERE files >= 5 AND files * 50 >= total
    """,
}
