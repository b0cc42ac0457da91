"""Exact quantile (linear interpolation) without gathering the column.

``percentile`` keeps every value of a group in one aggregation buffer,
which does not survive billions of rows. Here the column is read twice. The
first pass counts it and sketches two quantiles around the wanted one, in
mergeable sketches, one for each task; the second keeps what lies between
them as (value, count), written to the checkpoint folder, and counts what
lies below, so that a sketch that missed shows and is widened. What was
kept is narrowed, without the column, to ``max_collect`` values, which the
driver walks. The result is the exact linear-interpolation
quantile, identical to ``percentile``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Parts that a narrowing step tells apart.
PARTS = 100


def _value_at(pairs: DataFrame, rank: int, max_collect: int, accuracy: int) -> float:
    """The value at a 0-based ascending rank of distinct (v, n)."""
    v = F.col("v")
    while pairs.count() > max_collect:
        cuts = pairs.agg(F.percentile_approx(v, [i / PARTS for i in range(1, PARTS)], accuracy).alias("q")).first()["q"]
        cuts = sorted(set(cuts))
        below = [0, *pairs.agg(*[F.coalesce(F.sum(F.when(v < c, F.col("n"))), F.lit(0)) for c in cuts]).first()]
        at = max(i for i, n in enumerate(below) if n <= rank)
        rank -= below[at]
        pairs = pairs.where(((v >= cuts[at - 1]) if at else F.lit(True))
                            & ((v < cuts[at]) if at < len(cuts) else F.lit(True)))
    for row in pairs.orderBy("v").collect():
        if rank < row.n:
            return float(row.v)
        rank -= row.n
    raise RuntimeError("the values changed while their quantile was computed")


def exact_quantile(df: DataFrame, col: str, q: float, max_collect: int = 10_000,
                   accuracy: int = 10_000) -> float | None:
    """Exact ``q``-quantile of ``col`` (NULL and NaN ignored), linear
    interpolation between the two neighbouring order statistics."""
    v = F.col("v")
    values = df.select(F.col(col).cast("double").alias("v")).where(v.isNotNull() & ~F.isnan("v"))
    eps = 2.0 / accuracy
    while True:
        lo, hi = max(0.0, q - eps), min(1.0, q + eps)
        first = values.agg(F.count("v").alias("n"), F.percentile_approx(v, [lo, hi], accuracy).alias("q")).first()
        if first.n == 0:
            return None
        # at the ends of the column the bracket is open
        above = F.lit(True) if lo == 0 else v >= first.q[0]
        upto = F.lit(True) if hi == 1 else v <= first.q[1]
        seen = Observation()
        pairs = (values.observe(seen, F.count_if(~above).alias("below"), F.count_if(above & upto).alias("kept"))
                 .where(above & upto).groupBy("v").agg(F.count("v").alias("n")).checkpoint(eager=True))
        below, kept = seen.get["below"], seen.get["kept"]
        position = q * (first.n - 1)
        k = math.floor(position)
        ranks = [k] + ([k + 1] if position > k and k + 1 < first.n else [])
        if below <= ranks[0] and ranks[-1] < below + kept:
            break
        eps *= 4
    got = [_value_at(pairs, r - below, max_collect, accuracy) for r in ranks]
    return got[0] if got[0] == got[-1] else got[0] + (got[-1] - got[0]) * (position - k)
