"""Token budget of texts and slices (problem 2).

Texts are cut into the vocabulary's pieces; each worker keeps the distinct pieces as symbol arrays and finds their token counts by
rounds of joining adjacent symbols with the merge ranks and merging each piece's lowest-ranked pair until none is left. A text's
count is the sum over its pieces, so counting needs no shuffle; only sums per slice are exchanged.

Defined results: null and empty texts count 0 tokens; null group values form their own group; no length limit; repeated rows count
each time (a path planned twice counts once); an empty table gives no rows; the result's column wins over one of its name."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm import bytepair
from lexmill.scale import table

#: Names of languages in use, as far as they don't begin with their own code.
LANGUAGE_NAMES = {
    "deutsch": "de", "english": "en", "español": "es", "espanol": "es", "français": "fr", "francais": "fr", "french": "fr", "german": "de", "ger": "de", "deu": "de",
    "italian": "it", "italiano": "it", "polish": "pl", "polski": "pl", "pol": "pl", "portuguese": "pt", "português": "pt", "portugues": "pt", "por": "pt",
    "russian": "ru", "rus": "ru", "русский": "ru", "spanish": "es", "spa": "es", "eng": "en", "fre": "fr", "fra": "fr", "ita": "it",
}


def language_code(c: Column) -> Column:
    """One style of language: lower case, without region; null if absent or empty."""
    plain = F.lower(F.trim(c))
    names = F.create_map(*[F.lit(x) for kv in sorted(LANGUAGE_NAMES.items()) for x in kv])
    short = F.split(plain, "[-_ ]").getItem(0)
    return F.when(plain == "", None).otherwise(F.coalesce(names[plain], names[short], short))


def count_tokens(df: DataFrame, text: str = "text", out: str = "tokens", vocabulary: str | None = None, drop_text: bool = True) -> DataFrame:
    """df with the number of tokens of text; the text itself is left out unless drop_text is false."""
    path = bytepair.vocabulary_path(vocabulary or bytepair.VOCABULARY)
    keep = [c for c in df.columns if c != out and not (drop_text and c == text)]
    narrow = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_counted"))
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField(out, T.LongType())])
    names = [f.name for f in schema.fields]

    def run(batches):
        counts, split = bytepair.counts(path), bytepair.splitter()
        for batch in batches:
            pieces = [split(t) if t else () for t in batch.column(batch.num_columns - 1).to_pylist()]
            counts.learn(set().union(*pieces))
            sums = pa.array([sum([counts[p] for p in x]) for x in pieces], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sums], names=names)

    return narrow.mapInArrow(run, schema)


def latest_jobs(jobs: DataFrame) -> DataFrame:
    """The crawl ledger's last state by text_path: the greatest updated, rows without a time last, then the greatest attempts and id."""
    state = F.struct(F.col("updated").isNotNull().alias("dated"), "updated", "attempts", "id", "metadata")
    return jobs.filter("text_path IS NOT NULL").groupBy("text_path").agg(F.max(state).alias("s")).select("text_path", "s.metadata")


def token_budget(df: DataFrame, by: list[str], text: str = "text", words: str | None = None) -> DataFrame:
    """Texts and tokens of each slice, the total of words beside them if that column is named."""
    counted = count_tokens(df.select(*by, text, *([words] if words else [])), text)
    aggs = [F.count("*").alias("texts"), F.sum("tokens").alias("tokens")] + ([F.sum(words).cast("long").alias(words)] if words else [])
    return counted.groupBy(*by).agg(*aggs)


def plan_with_texts(spark, d) -> DataFrame:
    """One row for each planned path with its text and language. Of several rows of a path, the greatest (words_out, kind) holds."""
    plan = table(spark, d, "plan").groupBy("source", "path").agg(F.max(F.struct("words_out", "kind", "words")).alias("p")).select("source", "path", "p.*")
    files = table(spark, d, "files").select("path", "text")
    jobs = latest_jobs(table(spark, d, "jobs")).select(F.col("text_path").alias("path"), language_code(F.get_json_object("metadata", "$.language")).alias("language"))
    counted = count_tokens(files)
    return plan.join(counted, "path", "left").join(jobs, "path", "left")


def p2_budget(spark, d):
    """Both corpora in one report: documents by source, lang and genre (as domain); plan by source, language and kind (as domain)."""
    docs = table(spark, d, "documents").select("source", language_code(F.col("lang")).alias("language"), F.col("genre").alias("domain"), "text")
    a = token_budget(docs, ["source", "language", "domain"]).select(F.lit("documents").alias("corpus"), "source", "language", "domain", "texts", "tokens", F.lit(None).cast("long").alias("words_out"), F.lit(None).cast("long").alias("tokens_out"))
    planned = plan_with_texts(spark, d)
    share = F.when(F.col("words") > 0, F.coalesce("tokens", F.lit(0)) * F.col("words_out") / F.col("words"))
    b = planned.groupBy("source", "language", F.col("kind").alias("domain")).agg(
        F.count("*").alias("texts"), F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"), F.sum("words_out").cast("long").alias("words_out"), F.sum(F.floor(share)).cast("long").alias("tokens_out")
    )
    return a.unionByName(b.select(F.lit("plan").alias("corpus"), "source", "language", "domain", "texts", "tokens", "words_out", "tokens_out"))


def p2_tokens(spark, d):
    """Tokens of each document."""
    return count_tokens(table(spark, d, "documents").select("doc_id", "text"))


QUERIES = {"p2_budget": p2_budget, "p2_tokens": p2_tokens}
