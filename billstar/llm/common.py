"""Shared pieces of the operators: word pattern, folds, written
intermediate tables, bounded label samples and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.session import scratch_dir
from billstar.sources import fs

#: A word is a run of anything but space and the control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(columns: list[str]) -> list[str]:
    """Column names as they can be selected whatever characters they hold."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (0 for a NULL id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(0))


def written(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut, the table survives lost executors, and each consumer
    reads only the columns it needs."""
    path = scratch_dir(spark, f"llm-{tag}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for df in tables:
        fs.delete(df.sparkSession, df.written_to)


def label_sample(
    documents: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: dict[int, int]
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class[k]`` labelled documents of
    class k (0 or 1): those with the lowest hash of their id, so reruns agree.

    Only ids that ``documents`` has with a text count towards the bound, which
    makes the id list safe to broadcast; of the documents only ids are
    shuffled. NULL labels, ids and texts are left out; a doc_id labelled
    twice counts once, with its lowest label, and one that ``documents``
    repeats comes once, with its first text by code point.
    """
    texts = documents.select("doc_id", "text").where("doc_id is not null and text is not null")
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & keep)
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    order = F.xxhash64(F.lit("sample"), "doc_id")
    some = [
        ids.where(F.col("label") == k).orderBy(order, "doc_id").limit(per_class[k]) for k in (0, 1)
    ]
    sample = texts.join(F.broadcast(some[0].union(some[1])), "doc_id")
    return sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges(u, v)``: one row
    (node, component) per node of an edge, component the smallest node id.

    Alternates two star steps until the edge set stays as it is. A large star ties every
    larger neighbour of a node to the smallest id in its neighbourhood; a
    small star does so for the smaller neighbours. The minima combine
    map-side, a hub's rows are split by the skew join, and each round is a
    written table, so neither a hub nor a long chain gathers in one task.
    """
    e = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v").distinct()
    )
    e = written(spark, e, "edges")
    state = None
    while True:
        now = e.select(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == state or now.n == 0:
            break
        state = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        )
        shorter = written(spark, small, "edges")
        discard(e)
        e = shorter
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)


def logistic_fit(x, y, ridge: float = 1e-2, steps: int = 60):
    """Weights (centre, scale, coefficients with the intercept first) of a
    ridge logistic regression by Newton steps on a bounded sample."""
    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    if len(y) == 0:
        return np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1] + 1)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / scale]
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + np.diag(penalty)
        step = np.linalg.solve(hess, z.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
    return centre, scale, w


def logistic_predict(model, x):
    centre, scale, w = model
    z = w[0] + ((np.asarray(x, dtype=float) - centre) / scale) @ w[1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
