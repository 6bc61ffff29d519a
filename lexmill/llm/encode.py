"""Encoding of the whole corpus with a public tokenizer (problem 8).

Each text is cut into the vocabulary's pieces; each distinct piece is encoded once per worker by the prefix dynamic program of
bytepair.PrefixEncoder. There is no shuffle: a row's ids depend on its text alone.

Defined results: null and empty texts give an empty list; strings of special tokens are ordinary text; no length limit; repeated
rows give equal rows; an empty table gives an empty table; further columns, one named like the result included, are left out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import bytepair
from lexmill.scale import table


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """key and the ids of text, one row for each row of df."""
    path = bytepair.vocabulary_path(vocabulary or bytepair.VOCABULARY)
    narrow = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    def run(batches):
        store, split = bytepair.store(path), bytepair.splitter()
        for batch in batches:
            packed = [b"".join([store[p] for p in split(t)]) if t else b"" for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, packed)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["_key", "_ids"])

    kind = narrow.schema["_key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"_key {kind}, _ids array<int>").select(F.col("_key").alias(key), F.col("_ids").alias(out))


def p8_ids(spark, d):
    return encode_texts(table(spark, d, "documents"))


QUERIES = {"p8_ids": p8_ids}
