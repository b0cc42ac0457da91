"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors within cosine t lie within squared distance D = 2 - 2t. After
a fixed rotation, which spreads the distance evenly, the dimensions are split into
m blocks; if all blocks differed by more than D / m, so would the whole by more
than D. So every linked pair is within D / m in some block. Taken as a ring, some
such block is also within 2 D / m together with its successor (start behind the
block at which the sum of all differences so far exceeds its share the most), so
a pair is met where both hold. Each block's range join runs over a grid on its
first axes, with cells as wide as the block's radius; the union of the blocks'
pairs is then verified exactly.

A row of the join holds an id, a 64-bit hash of its cell and the coordinates of
two blocks; pairs that only a collision brings together fail the exact check. A
vector goes to 5 or 14 cells a block, by the size of its label. Crowded cells are
cut into slices on both sides, and every slice meets every other: the work of a
join key is bounded, and rows grow with the fullest cell by its slices only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import product
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.llm.common import components, discard, written

#: Dimensions of a block.
BLOCK = 8
#: Distinct vectors of a label from which the grid divides a third axis; the
#: most axes it divides. Another axis would cost three times the look-ups and,
#: where the block's radius is about the spread of a coordinate, spare a quarter
#: of the comparisons.
THIRD_AXIS, MOST_AXES = 16_000, 3
#: Vectors of a cell from which it is cut into slices.
CELL = 20_000
#: Slack of the budgets, relative and absolute, for sums in single precision.
SLACK = 1e-5


@cache
def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix for vectors of this length."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def axes_for(vectors: int) -> int:
    """Axes of a block that the grid divides in a label of so many distinct
    vectors. Any number gives the same pairs."""
    return 2 if vectors < THIRD_AXIS else MOST_AXES


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """(rid, label, embedding, dim, copies): equal vectors of a label as one,
    named by their smallest vec_id. Unusable vectors are left out."""
    e = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    good = F.expr(
        "vec_id is not null and label is not null and embedding is not null and size(embedding) > 0 "
        "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        "and exists(embedding, x -> x <> 0)")
    reps = e.where(good).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rid"), F.countDistinct("vec_id").alias("copies"))
    return reps.withColumn("dim", F.size("embedding"))


def blocks(reps: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """A row per vector and block: rid, label, dim, block, budget, axes, the
    grid cell g0, g1, ... (0 beyond the axes), the block's coordinates x0..x7
    and its successor's, y (padded with 0). ``sizes`` has the distinct
    vectors n of each label and dim."""
    squared = 2 - 2 * threshold
    axes_of = axes_for

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (dim, n), part in pdf.groupby(["dim", "n"]):
                v = np.stack(part.embedding.to_list()).astype(float)
                # scaled before the norm is taken, so that no square overflows
                v /= np.abs(v).max(axis=1, keepdims=True)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                v = v @ rotation(int(dim))
                m = -(-int(dim) // BLOCK)
                v = np.pad(v, ((0, 0), (0, m * BLOCK - int(dim))))
                axes = min(MOST_AXES, axes_of(int(n)))
                budget = squared / m * (1 + SLACK) + SLACK
                for b in range(m):
                    x, after = v[:, b * BLOCK:(b + 1) * BLOCK], (b + 1) % m
                    y = v[:, after * BLOCK:(after + 1) * BLOCK] if m > 1 else np.zeros_like(x)
                    cell = np.floor(x[:, :axes] / sqrt(budget)).astype(np.int32)
                    yield pd.DataFrame({
                        "rid": part.rid.to_numpy(), "label": part.label.to_numpy(), "dim": int(dim), "block": b,
                        "budget": budget, "axes": axes,
                        **{f"g{i}": cell[:, i] if i < axes else 0 for i in range(MOST_AXES)},
                        **{f"x{i}": x[:, i] for i in range(BLOCK)}, "y": list(y.astype(np.float32))})

    columns = "rid long, label {}, dim int, block int, budget double, axes int, ".format(
        reps.schema["label"].dataType.simpleString())
    columns += ", ".join(
        [f"g{i} int" for i in range(MOST_AXES)] + [f"x{i} float" for i in range(BLOCK)] + ["y array<float>"])
    return reps.join(sizes, ["label", "dim"]).select("rid", "label", "embedding", "dim", "n").mapInPandas(split, columns)


KEYS = ["label", "dim", "block", *[f"g{i}" for i in range(MOST_AXES)]]


def crowded(parts: DataFrame) -> DataFrame:
    """The cells of more than CELL vectors and the slices each is cut into:
    at most one row for CELL rows of ``parts``."""
    return parts.groupBy(*KEYS).count().where(F.col("count") > CELL).select(
        *KEYS, F.ceil(F.col("count") / CELL).cast("int").alias("slices"))


def probes(parts: DataFrame, cells: DataFrame) -> DataFrame:
    """A row for each cell that a vector looks into, its own and the half of
    the neighbours that follow, and each slice of it; own tells the first."""
    def ahead(axes: int) -> str:
        steps = [o + (0,) * (MOST_AXES - axes) for o in product((-1, 0, 1), repeat=axes) if o >= (0,) * axes]
        return "array({})".format(", ".join(
            "named_struct({})".format(", ".join(f"'o{i}', {v}" for i, v in enumerate(o))) for o in steps))

    cases = " ".join(f"when {a} then {ahead(a)}" for a in range(MOST_AXES + 1))
    probe = parts.withColumn("o", F.explode(F.expr(f"case axes {cases} end")))
    probe = probe.withColumn("own", F.expr(" and ".join(f"o.o{i} = 0" for i in range(MOST_AXES))))
    for i in range(MOST_AXES):
        probe = probe.withColumn(f"g{i}", F.col(f"g{i}") + F.col(f"o.o{i}"))
    return _celled(probe, cells, "own", "budget", order="mine, other")


def homes(parts: DataFrame, cells: DataFrame) -> DataFrame:
    """A row for each vector in its cell and each slice that looks into it."""
    return _celled(parts, cells, order="other, mine")


def _celled(rows: DataFrame, cells: DataFrame, *columns: str, order: str) -> DataFrame:
    """The rows of the join: cell (label, dim, block, grid cell, slice of
    the probe, slice of the home), rid, the coordinates and ``columns``."""
    met = rows.join(cells, KEYS, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    met = met.withColumn("mine", F.expr("cast(pmod(xxhash64(rid), slices) as int)")).withColumn(
        "other", F.explode(F.expr("sequence(0, slices - 1)")))
    return met.selectExpr(
        f"xxhash64({', '.join(KEYS)}, {order}) as cell", "rid", *columns, *[f"x{i}" for i in range(BLOCK)], "y")


def candidates(parts: DataFrame, cells: DataFrame) -> DataFrame:
    """(a, b): pairs within some block's budget, and within twice the budget
    together with its successor; a row for each pair.

    A pair is met once a block. The block's distance is part of the join,
    which compares the most; that with the successor is worked out for the
    pairs that leave it, and the least over their blocks decides.
    """
    first = " + ".join("({0}) * ({0})".format(f"p.x{i} - q.x{i}") for i in range(BLOCK))
    second = " + ".join("({0}) * ({0})".format(f"p.y[{i}] - q.y[{i}]") for i in range(BLOCK))
    met = probes(parts, cells).alias("p").join(homes(parts, cells).alias("q"), F.expr(
        f"p.cell = q.cell and p.rid <> q.rid and (not p.own or p.rid < q.rid) and {first} <= p.budget"))
    met = met.selectExpr("least(p.rid, q.rid) as a", "greatest(p.rid, q.rid) as b",
                         f"{first} + {second} - 2 * p.budget as excess")
    return met.groupBy("a", "b").agg(F.min("excess").alias("excess")).where("excess <= 0").select("a", "b")


def link(spark: SparkSession, embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per embedding row: vec_id, n_links, component_id, kept.

    Only vectors of equal, non-NULL label and equal length are compared, by cosine in
    double precision. n_links counts other vectors (distinct ids) at
    ``threshold`` or above, copies included; component_id is the smallest
    vec_id that links reach. Unusable vectors and NULL ids link with
    nothing. Other columns are not read.
    """
    reps = written(spark, distinct_vectors(embeddings), "vectors")
    # written, so that the joins with them know their size
    sizes = written(spark, reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "sizes")
    parts = written(spark, blocks(reps, sizes, threshold), "blocks")
    cells = written(spark, crowded(parts), "crowded")
    pairs = written(spark, candidates(parts, cells), "candidates")
    discard(parts, sizes, cells)
    # scaled by the largest component once a vector, so that no product
    # over- or underflows; the squared norm goes along
    vector = reps.withColumn("top", F.expr("aggregate(embedding, 0D, (s, x) -> greatest(s, abs(x)))")).selectExpr(
        "rid", "label", "copies", "transform(embedding, x -> x / top) as v")
    dot = "aggregate(zip_with({0}, {1}, (x, y) -> x * y), 0D, (s, x) -> s + x)"
    vector = written(spark, vector.withColumn("vv", F.expr(dot.format("v", "v"))), "scaled")
    met = pairs
    for side in "ab":
        met = met.join(vector.selectExpr(
            f"rid as {side}", f"label as {side}_label", f"copies as {side}_copies", f"v as {side}_v", f"vv as {side}_vv"), side)
    cosine = f"{dot.format('a_v', 'b_v')} / sqrt(a_vv * b_vv)"
    met = met.where(f"a_label = b_label and size(a_v) = size(b_v) and {cosine} >= {threshold}D").select("a", "b", "a_copies", "b_copies")
    links = written(spark, met, "links")
    discard(pairs, vector)

    ends = links.selectExpr("a as rid", "b_copies as n").union(links.selectExpr("b", "a_copies"))
    degree = ends.groupBy("rid").agg(F.sum("n").alias("n"))
    joined = components(spark, links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    found = reps.join(degree, "rid", "left").join(joined.withColumnRenamed("node", "rid"), "rid", "left").selectExpr(
        "label", "embedding", "coalesce(n, 0) + copies - 1 as n_links", "coalesce(component, rid) as component")
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    out = rows.join(found, ["label", "embedding"], "left")
    component = "if(vec_id is null, null, coalesce(component, vec_id))"
    return out.selectExpr(
        "vec_id", "if(vec_id is null, 0, coalesce(n_links, 0)) as n_links", f"{component} as component_id",
        f"coalesce(vec_id = {component}, true) as kept")


def oracle(threshold: float = 0.93) -> str:
    """The same rows in DuckDB SQL over a view embeddings, by all pairs."""
    return f"""
        WITH RECURSIVE e AS (
            SELECT DISTINCT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
        good AS (
            SELECT *, list_dot_product(v, v) AS vv FROM e
            WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(v, lambda x: x <> 0)) > 0),
        link AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_dot_product(a.v, b.v) / sqrt(a.vv * b.vv) >= {threshold}),
        reach AS (
            SELECT DISTINCT vec_id AS x, vec_id AS y FROM embeddings WHERE vec_id IS NOT NULL
            UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
        low AS (SELECT x, min(y) AS component FROM reach GROUP BY x),
        degree AS (SELECT x, count(DISTINCT y) AS n FROM link GROUP BY x)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component AS component_id,
               coalesce(vec_id = component, TRUE) AS kept
        FROM embeddings LEFT JOIN low ON vec_id = low.x LEFT JOIN degree ON vec_id = degree.x"""
