"""Isolation-forest anomaly labels on unpaid invoices.

Isolation forest (Liu, Ting, Zhou 2008) on Spark:

1. features (L1): unpaid invoices; unpaid amount, delay, lines; NULL -> 0.
2. scaling (L2): mean and population std in one aggregate (std 0 -> 1);
   the six numbers go to the driver and come back as literals.
3. sampling (L3): each tree gets a Bernoulli sample of about 1.3 * psi
   rows chosen by hashing (fact_id, tree, seed) - no driver sampling, no
   shuffle of the full data; a row-number cap keeps exactly <= psi rows
   per tree. Groups are bounded by psi, never by the data.
4. fitting (L3): ``groupBy("tree").applyInPandas`` grows one tree per
   group with numpy (random feature, random split in [min, max], height
   limit ceil(log2 psi)). Output <= trees * (2 psi - 1) node rows.
5. scoring (L4): the node table (bounded) is collected and broadcast to a
   vectorised ``mapInPandas`` that walks all trees for a whole Arrow
   batch at once; s = 2^(-E[h] / c(psi)), score = -s.
6. threshold (G26): exact ``contamination`` quantile of the scores,
   computed distributedly; label -1 where score < threshold, else 1;
   decision = score - threshold.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.functions.quantile import exact_quantile

FEATURES = ("montant_impaye", "delai_paiement_jours", "nombre_lignes")
EULER = 0.5772156649015329
TWO53 = float(1 << 53)

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("psi", T.IntegerType()),
])


def avg_path(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


# ---------------------------------------------------------------- features
def features(fact: DataFrame) -> DataFrame:
    """Unpaid invoices with the three features as doubles (NULL -> 0)."""
    return fact.where(F.col("montant_impaye") > 0).select(
        "fact_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])


def scaler_stats(feat: DataFrame, *also: F.Column) -> DataFrame:
    """One row: mean_<f>, std_<f> (population; a zero std becomes 1), and
    what else the same pass is to aggregate."""
    aggs = list(also)
    for c in FEATURES:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"mean_{c}"),
                 F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd).alias(f"std_{c}")]
    return feat.agg(*aggs)


def scale(feat: DataFrame, stats: dict) -> DataFrame:
    return feat.select("fact_id", *[
        ((F.col(c) - F.lit(stats[f"mean_{c}"])) / F.lit(stats[f"std_{c}"])).alias(f"z_{c}") for c in FEATURES])


# ---------------------------------------------------------------- sampling
def _uniform(*cols) -> F.Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)).cast("double") / F.lit(TWO53)


def tree_samples(scaled: DataFrame, n: int, trees: int, psi: int, seed: int) -> DataFrame:
    """(tree, fact_id, z...) with <= psi rows per tree."""
    p = min(1.0, 1.3 * psi / max(n, 1))
    q = min(1.0, trees * p)
    per_tree = p / q
    s = F.lit(seed)
    kept = scaled.where(_uniform(F.col("fact_id"), s) < q)
    pick = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                    lambda t: _uniform(F.col("fact_id"), t, s + 1) < per_tree)
    exploded = kept.select(F.explode(pick).alias("tree"), "*")
    from pyspark.sql import Window
    w = Window.partitionBy("tree").orderBy(F.xxhash64(F.col("fact_id"), F.col("tree"), s + 2), "fact_id")
    return exploded.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= psi).drop("_rn")


# ------------------------------------------------------------------ fitting
def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Iterative isolation tree; returns node arrays."""
    feat, thr, left, right, size = [], [], [], [], []
    stack = [(np.arange(len(x)), 0, None, None)]  # (rows, depth, parent, side)
    while stack:
        rows, depth, parent, side = stack.pop()
        nid = len(feat)
        feat.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        size.append(len(rows))
        if parent is not None:
            (left if side == 0 else right)[parent] = nid
        if depth >= max_depth or len(rows) <= 1:
            continue
        sub = x[rows]
        mins, maxs = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(maxs > mins)
        if len(candidates) == 0:
            continue
        f = int(candidates[rng.integers(len(candidates))])
        t = float(rng.uniform(mins[f], maxs[f]))
        go_left = sub[:, f] < t
        feat[nid], thr[nid] = f, t
        stack.append((rows[~go_left], depth + 1, nid, 1))
        stack.append((rows[go_left], depth + 1, nid, 0))
    return feat, thr, left, right, size


def fit_trees(samples: DataFrame, seed: int, psi_cap: int) -> DataFrame:
    zcols = [f"z_{c}" for c in FEATURES]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fact_id")
        tree = int(pdf["tree"].iloc[0])
        x = pdf[zcols].to_numpy(dtype=float)
        psi = min(psi_cap, len(x))
        depth = int(math.ceil(math.log2(max(psi, 2))))
        rng = np.random.default_rng([seed, tree])
        feat, thr, left, right, size = _grow(x, rng, depth)
        k = len(feat)
        return pd.DataFrame({"tree": [tree] * k, "node": list(range(k)), "feature": feat, "threshold": thr,
                             "left": left, "right": right, "size": size, "psi": [psi] * k})

    return samples.groupBy("tree").applyInPandas(fit, NODE_SCHEMA)


# ------------------------------------------------------------------ scoring
def score(scaled: DataFrame, nodes: pd.DataFrame) -> DataFrame:
    """(fact_id, score) with score = -s (lower = more anomalous)."""
    trees = []
    for t, g in nodes.sort_values(["tree", "node"]).groupby("tree"):
        leaf_size = g["size"].to_numpy()
        trees.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                      g["right"].to_numpy(), avg_path(leaf_size)))
    psi = int(nodes["psi"].max())
    c_psi = float(avg_path(np.array([psi]))[0]) or 1.0
    zcols = [f"z_{c}" for c in FEATURES]
    # the forest (<= trees * (2 psi - 1) nodes) goes to each executor once
    forest = scaled.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        trees = forest.value
        for pdf in batches:
            x = pdf[zcols].to_numpy(dtype=float)
            m = len(x)
            total = np.zeros(m)
            idx = np.arange(m)
            for feat, thr, left, right, cleaf in trees:
                node = np.zeros(m, dtype=np.int64)
                depth = np.zeros(m)
                while True:
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[idx, np.where(inner, f, 0)] < thr[node]
                    node = np.where(inner, np.where(go_left, left[node], right[node]), node)
                    depth += inner
                total += depth + cleaf[node]
            mean_h = total / max(len(trees), 1)
            yield pd.DataFrame({"fact_id": pdf["fact_id"], "score": -np.power(2.0, -mean_h / c_psi)})

    return scaled.select("fact_id", *zcols).mapInPandas(run, "fact_id long, score double")


# ------------------------------------------------------------------- driver
class ForestResult:
    def __init__(self, scores: DataFrame | None, threshold: float | None, n: int, stats: dict | None,
                 nodes: pd.DataFrame | None):
        self.scores, self.threshold, self.n, self.stats, self.nodes = scores, threshold, n, stats, nodes


def score_anomalies(fact: DataFrame, trees: int = 100, psi: int = 256, contamination: float = 0.05,
                    seed: int = 42, min_rows: int = 10) -> ForestResult:
    """Fit and label. Returns scores=None when fewer than ``min_rows``
    unpaid invoices exist (earlier labels then stay in place)."""
    feat = features(fact)
    stats = scaler_stats(feat, F.count(F.lit(1)).alias("n")).first().asDict()
    n = stats.pop("n")
    if n < min_rows:
        return ForestResult(None, None, n, None, None)
    scaled = scale(feat, stats)
    nodes = fit_trees(tree_samples(scaled, n, trees, psi, seed), seed, min(psi, n)).toPandas()
    # Scores are read by several quantile passes and the labelling pass:
    # materialise once in the shared checkpoint folder (lineage cut, so a
    # lost executor does not re-run the forest).
    raw = score(scaled, nodes).checkpoint(eager=True)
    thr = exact_quantile(raw, "score", contamination)
    labelled = raw.select(
        "fact_id",
        F.when(F.col("score") < F.lit(thr), F.lit(-1)).otherwise(F.lit(1)).cast("int").alias("anomaly_score"),
        (F.col("score") - F.lit(thr)).alias("anomaly_decision"))
    return ForestResult(labelled, thr, n, stats, nodes)


def rule_scores(fact: DataFrame, contamination: float = 0.05) -> tuple[DataFrame, float | None]:
    """Labels by a stated rule instead of the forest: the score is minus
    the largest absolute scaled feature (6 decimals), the threshold its
    exact ``contamination`` quantile. Same columns as the forest's labels;
    (None, None) without unpaid invoices."""
    feat = features(fact)
    stats = scaler_stats(feat).first().asDict()
    if stats[f"mean_{FEATURES[0]}"] is None:
        return None, None
    raw = scale(feat, stats).select(
        "fact_id", F.round(-F.greatest(*[F.abs(f"z_{c}") for c in FEATURES]), 6).alias("score"))
    thr = exact_quantile(raw, "score", contamination)
    return raw.select(
        "fact_id",
        F.when(F.col("score") < F.lit(thr), F.lit(-1)).otherwise(F.lit(1)).cast("int").alias("anomaly_score"),
        F.round(F.col("score") - F.lit(thr), 6).alias("anomaly_decision")), thr


def anomaly_rate(scores: DataFrame) -> DataFrame:
    """Number and share of anomalies among scored rows."""
    return scores.agg(F.count(F.lit(1)).alias("n_scored"),
                      F.count_if(F.col("anomaly_score") == -1).alias("n_anomalies")) \
        .withColumn("anomaly_pct", F.round(F.col("n_anomalies") * 100.0 / F.col("n_scored"), 1))
