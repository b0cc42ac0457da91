"""Hard-negative mining by a BOND vertical scan.

Vectors lie in blocks of columns. For an anchor, a block's dimensions are
read in descending order of the anchor's own magnitudes. After each few
dimensions every row has a partial inner product, and the smallest and
largest value of each column still to come bound what it can add. Rows
whose bounds leave every wanted window, or that enough rows are certain to
beat, drop out of the block's candidate set; what remains at the end has
its exact score.

Positives come first (the best rows of the anchor's own label), as their
scores set the windows in which the negatives are searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billstar.llm.common import discard, written

#: Rows of a block and anchors of a block; both bound a task's memory.
ROWS, ANCHORS = 32_768, 2_048
#: Dimensions read between two looks at the bounds.
STRIDE = 8
#: Components from here on are not exact after scaling; such rows take no part.
LARGEST = 2.0**44
#: What scores are returned within.
LONG = (-(1 << 63), (1 << 63) - 1)


@dataclass(frozen=True)
class Mining:
    #: Components are floor(scale * x).
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    #: A negative's score lies within these hundredths of the positive's.
    low: int = 30
    high: int = 90


def usable(embeddings: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(vec_id, label, dim, q): one row per vec_id, with integer components.

    Rows with a NULL id, label or vector, an empty vector, or a NULL,
    non-finite or huge (2**44 and above) component are left out. Repeated
    rows count once; of different rows under one vec_id the least by label and
    components is taken. Other columns are not read.
    """
    e = embeddings.selectExpr("vec_id", "label", "cast(embedding as array<double>) as v").where(
        "vec_id is not null and label is not null and v is not null and size(v) > 0 and "
        f"forall(v, x -> x is not null and not isnan(x) and abs(x) < {LARGEST}D)")
    e = e.selectExpr(
        "cast(vec_id as bigint) as vec_id", "label",
        f"transform(v, x -> cast(floor({float(mining.scale)}D * x) as bigint)) as q")
    one = e.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r"))
    return one.selectExpr("vec_id", "r.label", "size(r.q) as dim", "r.q")


# ------------------------------------------------------------ inside tasks
class Block:
    """Columns of a block of rows with their least and largest values."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.columns = ids[order], np.ascontiguousarray(rows[order].T)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
        """(positions, exact scores) of the rows that ``shrink`` keeps.
        ``shrink(low, high)`` gets bounds of the candidates' scores and
        says which may still matter (None: all)."""
        columns = self.columns
        if int(np.abs(anchor).max()) * int(max(-self.least.min(), self.most.max(), 1)) * len(anchor) >= 1 << 62:
            columns, anchor = columns.astype(object), anchor.astype(object)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least, anchor * self.most])[:, order]
        rest_low = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        at, score = None, np.zeros(columns.shape[1], dtype=columns.dtype)
        for i in range(0, len(order), STRIDE):
            for j in order[i:i + STRIDE]:
                column = columns[j]
                score += anchor[j] * (column if at is None else column[at])
            done = min(i + STRIDE, len(order))
            keep = shrink(score + rest_low[done], score + rest_high[done])
            if keep is not None and not keep.all():
                at = np.flatnonzero(keep) if at is None else at[keep]
                score = score[keep]
                if not len(at):
                    break
        return (np.arange(columns.shape[1]) if at is None else at), score


def in_long(score) -> int:
    return min(max(int(score), LONG[0]), LONG[1])


def certain(low: np.ndarray, k: int):
    """The k-th largest lower bound: a row that cannot reach it is beaten by k others."""
    return np.sort(low)[-k] if low.dtype == object else np.partition(low, -k)[-k]


def best(block: Block, anchor: np.ndarray, skip: int, k: int) -> list[tuple[int, int]]:
    """The k rows of highest score but ``skip``, ties by id: (id, score)."""
    own = np.searchsorted(block.ids, skip)
    has_own = own < len(block.ids) and block.ids[own] == skip
    need = k + bool(has_own)

    def shrink(low, high):
        return high >= certain(low, need) if len(low) > need else None

    at, score = block.scan(anchor, shrink)
    found = [(int(block.ids[i]), in_long(s)) for i, s in zip(at, score) if not (has_own and i == own)]
    return sorted(found, key=lambda x: (-x[1], x[0]))[:k]


def windowed(block: Block, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """For each window (least and largest score) the first k rows in it."""
    windows_open = [(a, b) for a, b in windows if a <= b]
    if not windows_open:
        return [[] for _ in windows]

    def shrink(low, high):
        keep = np.zeros(len(low), dtype=bool)
        for a, b in windows_open:
            may = (low <= b) & (high >= a)
            sure = low[(low >= a) & (high <= b)]
            if len(sure) >= k:
                may &= high >= certain(sure, k)
            keep |= may
        return keep

    at, score = block.scan(anchor, shrink)
    out = []
    for a, b in windows:
        inside = np.flatnonzero((score >= a) & (score <= b)) if len(score) else []
        found = sorted(((int(block.ids[at[i]]), in_long(score[i])) for i in inside), key=lambda x: (-x[1], x[0]))
        out.append(found[:k])
    return out


# --------------------------------------------------------------- in blocks
def _blocks(rows: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
    """``rows`` with ``name``: a hash block of about ``size`` rows within ``by``."""
    counts = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    return rows.join(counts, by).withColumn(
        name, F.expr(f"pmod(xxhash64(vec_id), greatest(1L, cast(ceil(_n / {size}) as bigint)))")).drop("_n")


def _meet(rows: DataFrame, anchors: DataFrame, cells: DataFrame, keys: list[str], search, schema: str) -> DataFrame:
    """Run ``search(block rows, anchors)`` for every cell: a block of rows
    and a block of anchors, both bounded."""
    left = rows.join(cells, [c for c in cells.columns if c in rows.columns])
    right = anchors.join(cells, [c for c in cells.columns if c in anchors.columns])
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own: both sides stem from one table
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)


def mine(spark: SparkSession, rows: DataFrame, is_anchor: str, mining: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) over ``rows`` of :func:`usable`.

    ``is_anchor`` is a predicate on vec_id. An anchor's positives are the
    rows of its label with the highest inner products, ties by smaller
    vec_id; for each, the negatives are the first rows of other labels whose
    score lies within the window that the positive's score sets, ranked from
    1. Vectors of different lengths are not compared. Anchors without a
    positive, and positives without a negative in the window, give no row.
    A score beyond 64 bits is returned as the nearest such integer.

    Rows and anchors meet in blocks, each pair of blocks in a task, so a
    label with a third of all rows is many blocks. Each task returns at
    most the wanted number a window; nothing else is capped.
    """
    label = rows.schema["label"].dataType.simpleString()
    rows = written(spark, _blocks(rows, ["label", "dim"], ROWS, "block"), "vectors")
    anchors = rows.where(is_anchor).drop("block")

    # positives: blocks of a label meet the anchors of that label
    own = written(spark, _blocks(anchors, ["label", "dim"], ANCHORS, "anchor_block"), "anchors")
    cells = rows.select("label", "dim", "block").distinct().join(
        own.select("label", "dim", "anchor_block").distinct(), ["label", "dim"])
    p = mining.positives

    def find_best(block: pd.DataFrame, few: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(few):
            columns = Block(block.vec_id.to_numpy(), np.stack(block.q.to_list()))
            for a, q in zip(few.vec_id, few.q):
                out += [(a, i, s) for i, s in best(columns, np.asarray(q), a, p)]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])

    found = _meet(
        rows, own.select("vec_id", "q", "label", "dim", "anchor_block"),
        cells, ["label", "dim", "block", "anchor_block"], find_best,
        "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = found.withColumn("r", F.row_number().over(first)).where(f"r <= {p}").groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives"))

    # negatives: every block meets every block of anchors
    wanted = written(spark, _blocks(
        anchors.join(positives.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), ["dim"], ANCHORS, "anchor_block",
    ).withColumnRenamed("label", "anchor_label"), "wanted")
    discard(own)
    cells = rows.select("label", "dim", "block").distinct().join(
        wanted.select("dim", "anchor_block").distinct(), "dim")
    lo, hi, k = mining.low, mining.high, mining.negatives

    def find_windows(block: pd.DataFrame, few: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(few):
            columns, here = Block(block.vec_id.to_numpy(), np.stack(block.q.to_list())), block.label.iloc[0]
            for a, q, theirs, pairs in zip(few.vec_id, few.q, few.anchor_label, few.positives):
                if theirs == here:
                    continue
                scores = [int(x["positive_score"]) for x in pairs]
                # lo * s <= 100 * n <= hi * s, in integers
                windows = [(-(-lo * s // 100), hi * s // 100) for s in scores]
                for x, s, hits in zip(pairs, scores, windowed(columns, np.asarray(q), windows, k)):
                    out += [(a, x["positive_id"], i, s, n) for i, n in hits]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    met = _meet(
        rows, wanted.select("vec_id", "q", "anchor_label", "dim", "anchor_block", "positives"), cells,
        ["label", "dim", "block", "anchor_block"], find_windows,
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return met.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle(mining: Mining = Mining()) -> str:
    """The registered query in DuckDB SQL over a view embeddings, by all pairs."""
    return f"""
        WITH e AS (
            SELECT vec_id, min((label, v)) AS r FROM (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       list_transform(embedding, lambda x: floor({mining.scale} * x::DOUBLE)) AS v
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
            GROUP BY vec_id),
        q AS (SELECT vec_id, r[1] AS label, r[2] AS v FROM e),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                   list_dot_product(a.v, b.v)::BIGINT AS score
            FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
        positive AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {mining.positives}),
        met AS (
            SELECT p.*, other AS negative_id, score AS negative_score, row_number() OVER (
                       PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
            FROM positive p JOIN scored s USING (anchor_id)
            WHERE NOT same AND {mining.low} * positive_score <= 100 * score
                  AND 100 * score <= {mining.high} * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM met WHERE rank <= {mining.negatives}"""
