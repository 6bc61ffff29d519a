"""Sinks: JSON lines, partitioned and sharded output, convergent materialisation, token bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, its keys in order."""
    df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.mode("overwrite").text(path)


def write_by_kind(df: DataFrame, path: str, by: tuple[str, ...] = ("kind", "source")) -> None:
    """Folders by kind and source; only the partitions at hand are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def plan_key(df: DataFrame, *columns: str) -> DataFrame:
    """df with a digest of what a row's output hangs on."""
    return df.withColumn("plan_key", F.sha2(F.to_json(F.struct(*sorted(columns))), 256))


def convergent(expected: DataFrame, standing: DataFrame) -> DataFrame:
    """path and step: write where the digest differs or nothing stands, untouched where it agrees, trash where nothing is expected."""
    e = expected.select("path", F.col("plan_key").alias("_e"))
    s = standing.select("path", F.col("plan_key").alias("_s"))
    step = F.when(F.col("_e").isNull(), "trash").when(F.col("_s").isNull() | (F.col("_s") != F.col("_e")), "write").otherwise("untouched")
    return e.join(s, "path", "full_outer").select("path", step.alias("step"))


def write_tokens(df: DataFrame, path: str, ids: str = "ids", vocabulary: int = 65_536) -> DataFrame:
    """Token arrays in the narrowest type the vocabulary allows, and the sums that describe them."""
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.count("*").alias("texts"), F.sum(F.size(ids)).alias("tokens"), F.max(F.array_max(ids)).alias("greatest"), F.lit("uint16" if vocabulary <= 65_536 else "uint32").alias("width"))


def shard_stats(df: DataFrame, shard: str, reason: str) -> DataFrame:
    """Counts of each exit by shard: the checkpoint of a sharded run and the input of its final sum."""
    return df.groupBy(shard, reason).agg(F.count("*").alias("n"))
