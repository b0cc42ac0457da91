"""Quality report and gate (G2-G9, T3, T4) and constraints (K1-K7)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from billstar.operators import constraints as K
from billstar.operators import quality
from billstar.schema import SILVER

NOW = dt.datetime(2025, 6, 1)


def silver(spark, rows):
    base = dict(patient_id="P", patient_nom="n", patient_prenom="p", etablissement_id="E",
                etablissement_nom="e", service="S", date_facturation=dt.datetime(2025, 1, 1),
                montant_facture=Decimal("100.00"), statut_paiement="PAYE", montant_paye=Decimal("100.00"),
                date_paiement=None, nombre_lignes=1, montant_impaye=Decimal("0.00"), delai_paiement_jours=None,
                source_file="f.csv", load_timestamp=NOW)
    return spark.createDataFrame([{**base, **r} for r in rows], SILVER)


def test_report_counts(spark):
    df = silver(spark, [
        {},                                                   # duplicate pair with the next
        {},
        {"patient_id": None, "montant_facture": None},        # missing critical
        {"montant_facture": Decimal("-1.00"), "montant_paye": Decimal("-1.00")},  # negative
        {"date_facturation": dt.datetime(2025, 6, 2)},         # future
        {"montant_paye": Decimal("120.00")},                   # paid > billed
        {"date_paiement": dt.datetime(2024, 12, 31)},          # paid before billed
        {"patient_id": None, "montant_facture": None},        # NULL-equal duplicate of row 3
    ])
    r = quality.quality_report(df, NOW).first().asDict()
    assert r["total_rows"] == 8
    assert r["missing_patient_id"] == 2 and r["missing_montant_facture"] == 2
    assert r["missing_date_facturation"] == 0 and r["missing_etablissement_id"] == 0
    assert r["negative_amounts"] == 1 and r["future_dates"] == 1
    assert r["incoherent_amounts"] == 1 and r["incoherent_dates"] == 1
    # (P, 2025-01-01, 100) x4 -> 3 extra; (NULL, 2025-01-01, NULL) x2 -> 1 extra
    assert r["duplicates"] == 4


def test_gate_only_critical_faults_stop(spark):
    warn_only = silver(spark, [{"montant_paye": Decimal("120.00")}, {"etablissement_id": None}])
    assert quality.enforce_gate(quality.quality_report(warn_only, NOW))["verdict"] == "PASS"
    for bad in ({"montant_facture": Decimal("-1.00")}, {"patient_id": None}, {"montant_facture": None}):
        with pytest.raises(quality.QualityGateError):
            quality.enforce_gate(quality.quality_report(silver(spark, [bad]), NOW))


def test_null_comparisons_do_not_count(spark):
    df = silver(spark, [{"montant_paye": None}, {"date_paiement": None}])
    r = quality.quality_report(df, NOW).first()
    assert r["incoherent_amounts"] == 0 and r["incoherent_dates"] == 0


def test_constraint_violations_one_pass(spark):
    df = silver(spark, [{"montant_facture": Decimal("-5.00")}, {"montant_paye": None},
                        {"patient_nom": "x" * 101}]).withColumn("staging_id", __import__(
                            "pyspark.sql.functions", fromlist=["x"]).monotonically_increasing_id())
    rules = {**K.amount_rules(), **K.length_rules(), **K.not_null_rules(K.STAGING_NOT_NULL)}
    got = sorted(r["rule"] for r in K.violations(df, rules, "staging_id").collect())
    # NULL paid amount passes the CHECK, as in SQL
    assert got == ["check_montant_facture_positive", "length_patient_nom"]


def test_report_long_form(spark):
    r = quality.report_long(quality.quality_report(silver(spark, [{}]), NOW)).collect()
    assert {x["check_name"] for x in r} >= {"total_rows", "duplicates"}
