"""Exact nearest neighbours of a query set against all rows, in blocks of matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUERY_BLOCK, ROW_BLOCK = 512, 8192


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query, neighbour, rank (1 is nearest), similarity: the k rows of greatest cosine to each query, the query itself left out.

    Rows and queries are cut into blocks; each pair of blocks is one product of matrices in one task and hands on k candidates a query.
    Ties go to the smaller key. Null vectors and vectors of length 0 have no neighbours."""
    many, few = max(1, -(-rows.count() // ROW_BLOCK)), max(1, -(-queries.count() // QUERY_BLOCK))
    good = lambda df: df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    side = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    r = good(rows).withColumn("rb", F.pmod(F.xxhash64("k"), F.lit(many)).cast("int")).withColumn("qb", side(few))
    q = good(queries).withColumn("qb", F.pmod(F.xxhash64("k"), F.lit(few)).cast("int")).withColumn("rb", side(many))

    def product(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "neighbour": [], "similarity": []})
        right = right.sort_values("k")
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        a, b = unit(np.stack(left.v).astype(np.float64)), unit(np.stack(right.v).astype(np.float64))
        lk, rk = left.k.to_numpy(), right.k.to_numpy()
        s = a @ b.T
        s[lk[:, None] == rk[None, :]] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")[:, :k]
        out = pd.DataFrame({"query": np.repeat(lk, best.shape[1]), "neighbour": rk[best].ravel(), "similarity": np.take_along_axis(s, best, 1).ravel()})
        return out[np.isfinite(out.similarity)]

    each = q.groupBy("rb", "qb").cogroup(r.groupBy("rb", "qb")).applyInPandas(product, "query long, neighbour long, similarity double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("similarity"), "neighbour"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k)
