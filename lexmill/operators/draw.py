"""Seeded draws: weighted mixtures, shuffle bags, two pots, seats by turns. The same seed draws the same, whatever the partitions."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unit(*c: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that hangs on the columns and the seed alone."""
    return F.pmod(F.xxhash64(*[F.col(x) if isinstance(x, str) else x for x in c], F.lit(seed)), F.lit(1 << 52)).cast("double") / float(1 << 52)


def read_weights(text: str, known: set[str]) -> dict[str, float]:
    """Weights from JSON; raises ValueError for anything but a map of known names to finite numbers of at least 0, one of them above 0."""
    try:
        raw = json.loads(text)
    except ValueError as e:
        raise ValueError(f"no JSON: {e}") from None
    if not isinstance(raw, dict):
        raise ValueError("no map")
    for k, v in raw.items():
        if k not in known:
            raise ValueError(f"unknown shelf {k}")
        if isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(v) or v < 0:
            raise ValueError(f"weight of {k}: {v!r}")
    if not any(raw.values()):
        raise ValueError("all weights are 0")
    return {k: float(v) for k, v in raw.items()}


def mixture(draws: DataFrame, weights: dict[str, float], sizes: dict[str, int], draw: str = "draw", seed: int = 0) -> DataFrame:
    """draw, shelf, offset: each draw takes a shelf by weight and a uniform place in it; a weight of 0 is never drawn."""
    live = [(k, w) for k, w in sorted(weights.items()) if w > 0 and sizes.get(k, 0) > 0]
    total, low, rows = sum(w for _, w in live), 0.0, []
    for k, w in live:
        rows.append((k, low / total, (low + w) / total, sizes[k]))
        low += w
    if not rows:
        raise ValueError("nothing to draw from")
    rows[-1] = (*rows[-1][:2], 1.0, rows[-1][3])
    ranges = draws.sparkSession.createDataFrame(rows, "shelf string, low double, high double, size long")
    u = draws.select(draw, unit(draw, seed=seed).alias("_u"), unit(draw, seed=seed + 1).alias("_v"))
    return u.join(F.broadcast(ranges), (F.col("_u") >= F.col("low")) & (F.col("_u") < F.col("high"))).select(draw, "shelf", F.floor(F.col("_v") * F.col("size")).alias("offset"))  # a row for each shelf


def shuffle_bag(items: DataFrame, rounds: int, key: str, group: list[str] | None = None, seed: int = 0) -> DataFrame:
    """round, place, item: every round holds each item once, in an order of its own; within a group if named."""
    r = items.select(*(group or []), key).distinct().withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    return r.withColumn("place", F.row_number().over(W.partitionBy(*(group or []), "round").orderBy(F.xxhash64(F.col(key), F.col("round"), F.lit(seed)), key)))


def two_pots(draws: DataFrame, old: int, new: int, draw: str = "draw", seed: int = 0) -> DataFrame:
    """draw and pot: the second pot with probability min(1/2, its share of both)."""
    p = min(0.5, new / (old + new)) if old + new else 0.0
    return draws.select(draw, F.when(unit(draw, seed=seed) < p, "new").otherwise("old").alias("pot"))


def seats(turns: DataFrame, chairs: list[str], turn: str = "turn", down: str = "down") -> DataFrame:
    """turn and seat: chairs by turns; those in the array `down` are passed over; null if none is left."""
    n = len(chairs)
    all_ = F.array(*[F.lit(c) for c in chairs])
    start = F.pmod(F.col(turn) - 1, F.lit(n)).cast("int")
    order = F.concat(F.slice(all_, start + 1, n), F.slice(all_, F.lit(1), start))
    up = F.filter(order, lambda c: ~F.array_contains(F.coalesce(F.col(down), F.array().cast("array<string>")), c))
    return turns.select(turn, F.when(F.size(up) > 0, F.element_at(up, 1)).alias("seat"))
