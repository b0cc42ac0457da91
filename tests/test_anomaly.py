"""Isolation forest and exact quantile."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billstar.functions.quantile import exact_quantile
from billstar.operators import anomaly


def fact_frame(spark, n, planted=()):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        rows.append((i, float(rng.normal(1000, 100)), int(rng.integers(0, 60)), int(rng.integers(1, 10))))
    for j, (amt, delay, lines) in enumerate(planted):
        rows.append((n + j, float(amt), int(delay), int(lines)))
    return spark.createDataFrame(rows, "fact_id long, montant_impaye double, delai_paiement_jours int, "
                                       "nombre_lignes int")


def test_labels_threshold_and_planted_outliers(spark):
    f = fact_frame(spark, 2000, planted=[(50000, 900, 90), (40000, 800, 80)])
    res = anomaly.score_anomalies(f, trees=100, psi=256, contamination=0.05, seed=42)
    rows = res.scores.collect()
    assert {r.anomaly_score for r in rows} == {-1, 1}
    below = sum(1 for r in rows if r.anomaly_decision < 0)
    assert below == sum(1 for r in rows if r.anomaly_score == -1)
    assert abs(below - 0.05 * len(rows)) <= 2                # strict '<' against the 5 % quantile
    worst = sorted(rows, key=lambda r: r.anomaly_decision)[:2]
    assert {r.fact_id for r in worst} == {2000, 2001}


def test_same_result_under_repartition(spark):
    f = fact_frame(spark, 1500)
    a = {r.fact_id: r.anomaly_decision for r in anomaly.score_anomalies(f).scores.collect()}
    b = {r.fact_id: r.anomaly_decision for r in anomaly.score_anomalies(f.repartition(7)).scores.collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_too_few_rows_skips(spark):
    res = anomaly.score_anomalies(fact_frame(spark, 9))
    assert res.scores is None and res.n == 9
    assert anomaly.score_anomalies(fact_frame(spark, 10)).scores.count() == 10


def test_constant_feature_scales_to_zero(spark):
    f = fact_frame(spark, 50).withColumn("nombre_lignes", F.lit(1))
    stats = anomaly.scaler_stats(anomaly.features(f)).first().asDict()
    assert stats["std_nombre_lignes"] == 1.0
    z = anomaly.scale(anomaly.features(f), stats).agg(F.max(F.abs("z_nombre_lignes"))).first()[0]
    assert z == 0.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.sampled_from([0.0, 0.05, 0.5, 0.99, 1.0]))
def test_exact_quantile_matches_numpy(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert abs(exact_quantile(df, "x", q) - float(np.percentile(values, 100 * q))) < 1e-9


def test_exact_quantile_narrowing_path(spark):
    df = spark.range(0, 300_000).select((F.col("id") * 7 % 300_000).cast("double").alias("x"))
    got = exact_quantile(df, "x", 0.05, max_collect=5_000, accuracy=1_000)
    assert abs(got - np.percentile(np.arange(300_000, dtype=float), 5)) < 1e-9


@pytest.mark.parametrize("values", [
    [0.0] * 500 + [1.0] * 500, [float("inf"), 1.0, -1.0, float("-inf")] * 50, [3.5], [-0.0, 0.0, 5.0],
    [float(i % 7) for i in range(5_000)], [10.0 ** (i % 300 - 150) for i in range(5_000)]])
def test_quantiles_of_hostile_columns(spark, values):
    """Ties, infinities, signed zeros and uneven scales, with brackets too
    narrow for the driver's bound."""
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    ordered = sorted(values)
    for q in (0.0, 0.05, 0.5, 1.0):
        at = q * (len(values) - 1)
        k = int(at)
        up = ordered[min(k + 1, len(values) - 1)] if at > k else ordered[k]
        want = ordered[k] if up == ordered[k] else ordered[k] + (up - ordered[k]) * (at - k)
        got = exact_quantile(df, "x", q, max_collect=3, accuracy=20)
        assert got == pytest.approx(want) or (want != want and got != got), q


def test_a_quantile_reads_its_column_twice(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            reads.add(len(pdf))
            yield pdf

    df = spark.range(0, 40_000, 1, 4).selectExpr("cast(hash(id) as double) as x").mapInPandas(count, "x double")
    exact_quantile(df, "x", 0.05, max_collect=10)
    assert reads.value == 2 * 40_000


def test_samples_are_cut_to_size_before_their_exchange(spark):
    """Each task keeps at most psi rows of a tree, so the exchange carries
    the samples and not their surplus, and the features are read once."""
    scaled = anomaly.scale(anomaly.features(fact_frame(spark, 400)), {
        f"{k}_{c}": v for c in anomaly.FEATURES for k, v in (("mean", 0.0), ("std", 1.0))})
    plan = anomaly.tree_samples(scaled, 400, 10, 64, 1)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert exchange < partial and plan.count("Exchange") == 1      # a plan is printed from its top
