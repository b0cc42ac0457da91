"""Registered queries of the anomaly step and of everything that reads
its labels. Tree growth is randomised, so the forest and what reads its
labels are checked by properties in tests; the same readers run under a
rule-based score (``rule_*``) that SQL states as well."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from billstar.functions.quantile import exact_quantile
from billstar.operators import anomaly, marts, reports, views
from billstar.operators.fact import apply_scores
from billstar.plans.catalog import present, query
from billstar.plans.model import from_driver_tables


_FORESTS: dict[int, tuple] = {}


def _scored(spark, sf):
    """One forest per materialised model, shared by every query that reads
    its labels (the labels are then identical across those queries)."""
    m = from_driver_tables(spark, sf)
    if id(m) not in _FORESTS:
        o = m.opts
        res = anomaly.score_anomalies(m.fact, o.iforest_trees, o.iforest_psi, o.contamination, o.seed,
                                      o.min_rows_for_scoring)
        _FORESTS[id(m)] = (m, res, apply_scores(m.fact, res.scores))
    return _FORESTS[id(m)]


@query("ml_features")
def q_ml_features(spark, sf):
    m = from_driver_tables(spark, sf)
    return anomaly.features(m.fact)


@query("scan_unpaid_features")
def q_scan_unpaid_features(spark, sf):
    """SQL query as a source (A11): filter + projection on a named view."""
    m = from_driver_tables(spark, sf)
    view = f"fact_facturation_{uuid.uuid4().hex[:8]}"
    m.fact.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT fact_id, CAST(montant_impaye AS DOUBLE) AS montant_impaye, delai_paiement_jours, nombre_lignes
        FROM {view} WHERE montant_impaye > 0""")


@query("ml_scaler_stats")
def q_ml_scaler_stats(spark, sf):
    m = from_driver_tables(spark, sf)
    st = anomaly.scaler_stats(anomaly.features(m.fact))
    return st.select(*[F.round(c, 6).alias(c) for c in st.columns])


@query("ml_scaled")
def q_ml_scaled(spark, sf):
    m = from_driver_tables(spark, sf)
    feat = anomaly.features(m.fact)
    stats = anomaly.scaler_stats(feat).first().asDict()
    sc = anomaly.scale(feat, stats)
    return sc.select("fact_id", *[F.round(c, 6).alias(c) for c in sc.columns if c != "fact_id"])


@query("ml_iforest")
def q_ml_iforest(spark, sf):
    _, res, _ = _scored(spark, sf)
    return res.scores


@query("ml_threshold")
def q_ml_threshold(spark, sf):
    _, res, _ = _scored(spark, sf)
    return res.scores.agg(F.lit(res.threshold).alias("threshold"), F.count(F.lit(1)).alias("n_scored"),
                          F.count_if(F.col("anomaly_decision") < 0).alias("n_below"))


@query("ml_anomaly_rate")
def q_ml_anomaly_rate(spark, sf):
    _, res, _ = _scored(spark, sf)
    return anomaly.anomaly_rate(res.scores)


@query("fact_apply_scores")
def q_fact_apply_scores(spark, sf):
    _, _, fact = _scored(spark, sf)
    return present(fact.select("fact_id", "montant_impaye", "anomaly_score", "anomaly_decision"))


@query("mart_relance_scored")
def q_mart_relance_scored(spark, sf):
    m, _, fact = _scored(spark, sf)
    return present(marts.relance(fact, m.dims, m.opts.as_of))


@query("rep_relance_urgent")
def q_rep_relance_urgent(spark, sf):
    m, _, fact = _scored(spark, sf)
    return present(marts.relance_urgent(marts.relance(fact, m.dims, m.opts.as_of, sort=False)))


@query("rep_anomaly_clients")
def q_rep_anomaly_clients(spark, sf):
    m, _, fact = _scored(spark, sf)
    return present(reports.anomaly_clients(fact, m.dims))


@query("rep_anomaly_count")
def q_rep_anomaly_count(spark, sf):
    _, _, fact = _scored(spark, sf)
    return reports.anomaly_count(fact)


@query("rep_bandes_anomalie")
def q_rep_bandes_anomalie(spark, sf):
    _, _, fact = _scored(spark, sf)
    return present(reports.bandes_anomalie(fact))


@query("rep_features_top")
def q_rep_features_top(spark, sf):
    _, _, fact = _scored(spark, sf)
    return present(reports.features_top(fact))


# ------------------------------- the label readers under a stated score
_RULED: dict[int, tuple] = {}


def _ruled(spark, sf):
    """The model's fact under the rule-based labels (every value of which
    SQL can state), built once per materialised model."""
    m = from_driver_tables(spark, sf)
    if id(m) not in _RULED:
        scores, thr = anomaly.rule_scores(m.fact, m.opts.contamination)
        _RULED[id(m)] = (m, scores, thr, apply_scores(m.fact, scores))
    return _RULED[id(m)]


@query("rule_threshold")
def q_rule_threshold(spark, sf):
    _, scores, thr, _ = _ruled(spark, sf)
    return scores.agg(F.round(F.lit(thr), 6).alias("threshold"), F.count(F.lit(1)).alias("n_scored"),
                      F.count_if(F.col("anomaly_score") == -1).alias("n_below"))


@query("rule_quantile_feature")
def q_rule_quantile_feature(spark, sf):
    """G26 on plain feature columns."""
    feat = anomaly.features(from_driver_tables(spark, sf).fact)
    values = {c: exact_quantile(feat, c, 0.05) for c in anomaly.FEATURES}
    return feat.agg(*[F.round(F.lit(v), 6).alias(f"q05_{c}") for c, v in values.items()],
                    F.count(F.lit(1)).alias("n"))


@query("rule_labels")
def q_rule_labels(spark, sf):
    return _ruled(spark, sf)[1]


@query("rule_anomaly_rate")
def q_rule_anomaly_rate(spark, sf):
    return anomaly.anomaly_rate(_ruled(spark, sf)[1])


@query("rule_apply_scores")
def q_rule_apply_scores(spark, sf):
    return present(_ruled(spark, sf)[3].select("fact_id", "montant_impaye", "anomaly_score", "anomaly_decision"))


@query("rule_mart_relance")
def q_rule_mart_relance(spark, sf):
    m, _, _, fact = _ruled(spark, sf)
    return present(marts.relance(fact, m.dims, m.opts.as_of))


@query("rule_relance_urgent")
def q_rule_relance_urgent(spark, sf):
    m, _, _, fact = _ruled(spark, sf)
    return present(marts.relance_urgent(marts.relance(fact, m.dims, m.opts.as_of, sort=False)))


@query("rule_stats_etablissement")
def q_rule_stats_etablissement(spark, sf):
    m, _, _, fact = _ruled(spark, sf)
    return present(views.stats_etablissement(fact, m.dims))


@query("rule_anomaly_clients")
def q_rule_anomaly_clients(spark, sf):
    m, _, _, fact = _ruled(spark, sf)
    return present(reports.anomaly_clients(fact, m.dims))


@query("rule_anomaly_count")
def q_rule_anomaly_count(spark, sf):
    return reports.anomaly_count(_ruled(spark, sf)[3])


@query("rule_bandes_anomalie")
def q_rule_bandes_anomalie(spark, sf):
    out = present(reports.bandes_anomalie(_ruled(spark, sf)[3]))
    return out.withColumn("montant_impaye_moyen", F.round("montant_impaye_moyen", 4))


@query("rule_features_top")
def q_rule_features_top(spark, sf):
    return present(reports.features_top(_ruled(spark, sf)[3]))
