"""Star schema semantics: first-wins dims, insert-if-absent, NOT EXISTS
fact loads over two batches, NULL service, views, mart boundaries
(T5-T10, T19, T20, J1-J10, M1-M6)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from billstar.operators import marts, reports, views
from billstar.operators.dimensions import build_dims
from billstar.operators.fact import apply_scores, build_fact
from billstar.schema import SCORES, STAGING

TS = dt.datetime(2025, 6, 1)
AS_OF = dt.date(2025, 6, 1)


def staging(spark, rows):
    base = dict(patient_id="P1", patient_nom="Nom", patient_prenom="Pre", etablissement_id="E1",
                etablissement_nom="Clinique", service="URGENCES", date_facturation=dt.date(2025, 1, 1),
                date_paiement=None, montant_facture=Decimal("100.00"), montant_paye=Decimal("0.00"),
                montant_impaye=Decimal("100.00"), statut_paiement="IMPAYE", nombre_lignes=1,
                delai_paiement_jours=None, source_file="f.csv", load_timestamp=TS)
    return spark.createDataFrame([{**base, **r} for r in rows], STAGING)


def test_first_wins_and_keys(spark):
    st = staging(spark, [{"staging_id": 7, "patient_nom": "Second"}, {"staging_id": 3, "patient_nom": "First"},
                         {"staging_id": 9, "patient_id": "P2", "service": None}])
    dims, _ = build_dims(st, TS)
    p = {r.patient_id_naturel: r for r in dims.patient.collect()}
    assert p["P1"].nom == "First" and p["P1"].patient_key == 3     # lowest staging id wins
    assert p["P1"].valid_to == dt.datetime(9999, 12, 31) and p["P1"].is_current
    assert [r.service_code for r in dims.service.collect()] == ["URGENCES"]   # NULL service skipped
    d = dims.date.collect()[0]
    assert d.date_key == 20250101 and d.nom_mois == "Janvier" and d.jour_semaine == 3 and d.nom_jour == "Mercredi"
    fact = build_fact(st, dims, TS)
    rows = {r.fact_id: r for r in fact.collect()}
    assert set(rows) == {3, 7, 9}
    assert rows[9].service_key is None                              # left lookup


def test_two_batches_not_exists_semantics(spark):
    a = staging(spark, [{"staging_id": 1}, {"staging_id": 2}])                 # exact duplicate pair
    dims_a, _ = build_dims(a, TS)
    fact_a = build_fact(a, dims_a, TS)
    assert fact_a.count() == 2                                                   # both inserted (T5)
    b = staging(spark, [{"staging_id": 10, "service": "CHIRURGIE", "etablissement_id": "E9"},  # same key
                        {"staging_id": 11, "montant_facture": Decimal("55.00")},
                        {"staging_id": 12, "patient_id": "P1", "patient_nom": "Other"}])
    dims_b, new_b = build_dims(b, TS, existing=dims_a)
    assert new_b.patient.count() == 0                                            # existing never updated
    assert [r.nom for r in dims_b.patient.collect()] == ["Nom"]
    new_fact = build_fact(b, dims_b, TS, fact_snapshot=fact_a)
    assert sorted(r.fact_id for r in new_fact.collect()) == [11]                # 10, 12 suppressed


def test_same_batch_twice_is_idempotent(spark):
    a = staging(spark, [{"staging_id": i, "montant_facture": Decimal(i)} for i in range(1, 6)])
    dims, _ = build_dims(a, TS)
    fact = build_fact(a, dims, TS)
    again = a.withColumn("staging_id", F.col("staging_id") + 100)
    dims2, new = build_dims(again, TS, existing=dims)
    assert build_fact(again, dims2, TS, fact_snapshot=fact).count() == 0
    assert new.date.count() == 0 and new.patient.count() == 0


def _fact_with(spark, rows):
    st = staging(spark, rows)
    dims, _ = build_dims(st, TS)
    return build_fact(st, dims, TS), dims


def test_mart_boundaries_and_priorities(spark):
    d = lambda days: AS_OF - dt.timedelta(days=days)
    rows = [
        {"staging_id": 1, "date_facturation": d(30), "montant_impaye": Decimal("10.00")},    # not overdue
        {"staging_id": 2, "date_facturation": d(31), "montant_impaye": Decimal("10.00")},    # STANDARD
        {"staging_id": 3, "date_facturation": d(60), "montant_impaye": Decimal("10.00"), "patient_id": "P3"},
        {"staging_id": 4, "date_facturation": d(61), "montant_impaye": Decimal("10.00"), "patient_id": "P4"},
        {"staging_id": 5, "date_facturation": d(40), "montant_impaye": Decimal("5000.00"), "patient_id": "P5"},
        {"staging_id": 6, "date_facturation": d(40), "montant_impaye": Decimal("5000.01"), "patient_id": "P6"},
        {"staging_id": 7, "date_facturation": d(40), "montant_impaye": Decimal("1.00"), "patient_id": "P7"},
        {"staging_id": 8, "date_facturation": d(90), "montant_impaye": Decimal("0.00"), "patient_id": "P8"},
    ]
    fact, dims = _fact_with(spark, rows)
    scores = spark.createDataFrame([(7, -1, -0.3), (2, None, None)], SCORES)
    fact = apply_scores(fact, scores)
    got = {r.fact_id: r.priorite for r in marts.relance(fact, dims, AS_OF).collect()}
    assert got == {2: "STANDARD", 3: "STANDARD", 4: "IMPORTANT", 5: "STANDARD", 6: "PRIORITAIRE", 7: "URGENT"}
    order = [r.fact_id for r in marts.relance(fact, dims, AS_OF).collect()]
    assert order[0] == 7 and order[1] == 6                     # ranks 1, 2, then 3 by unpaid desc
    assert [r.fact_id for r in marts.relance_urgent(marts.relance(fact, dims, AS_OF)).collect()] == [7]
    pr = {r.priorite: r.nb_patients for r in reports.relance_priorite(marts.relance(fact, dims, AS_OF)).collect()}
    assert pr == {"URGENT": 1, "PRIORITAIRE": 1, "IMPORTANT": 1, "STANDARD": 3}


def test_zero_billed_month_has_null_rate(spark):
    fact, dims = _fact_with(spark, [{"staging_id": 1, "montant_facture": Decimal("0.00"),
                                     "montant_paye": Decimal("0.00"), "montant_impaye": Decimal("0.00")}])
    r = views.ca_mensuel(fact, dims).first()
    assert r.nombre_factures == 1 and r.taux_recouvrement_pct is None


def test_stats_view_rounding_and_anomaly_count(spark):
    fact, dims = _fact_with(spark, [
        {"staging_id": 1, "montant_facture": Decimal("10.00"), "delai_paiement_jours": 1},
        {"staging_id": 2, "montant_facture": Decimal("10.01"), "delai_paiement_jours": 2},
        {"staging_id": 3, "montant_facture": Decimal("10.01"), "delai_paiement_jours": None}])
    fact = apply_scores(fact, spark.createDataFrame([(1, -1, -0.2)], SCORES))
    r = views.stats_etablissement(fact, dims).first()
    assert str(r.montant_moyen_facture) == "10.01" and r.delai_moyen_paiement_jours == 1.5
    assert r.nombre_anomalies == 1


def test_score_overlay_keeps_old_labels(spark):
    fact, _ = _fact_with(spark, [{"staging_id": 1}, {"staging_id": 2, "patient_id": "P2"}])
    old = apply_scores(fact, spark.createDataFrame([(1, -1, -0.3), (2, 1, 0.1)], SCORES))
    new = apply_scores(old, spark.createDataFrame([(2, -1, -0.05)], SCORES))
    assert {r.fact_id: r.anomaly_score for r in new.collect()} == {1: -1, 2: -1}


def test_fk_orphans_and_unique(spark):
    from billstar.operators import constraints as K
    st = staging(spark, [{"staging_id": 1}, {"staging_id": 2, "patient_id": "P2"}])
    dims, _ = build_dims(st, TS)
    fact = build_fact(st, dims, TS)
    stale = build_dims(st.where("staging_id = 1"), TS)[0]
    orphans = K.fk_orphans(fact, stale).collect()
    assert [(r.constraint_name, r.fact_id) for r in orphans] == [("fk_fact_patient_key", 2)]
    assert K.duplicate_keys(dims.patient, "patient_id_naturel", "dim_patient").count() == 0
