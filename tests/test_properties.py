"""Property tests (hypothesis): the quality report equals a plain-Python
count, first-wins keys do not depend on partitioning, union keeps every
row, a second identical load inserts nothing."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from billstar.operators import quality
from billstar.operators.dimensions import build_dims
from billstar.operators.fact import build_fact
from billstar.operators.standardize import union_sources
from billstar.schema import SILVER, STAGING

NOW = dt.datetime(2025, 6, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

row_st = st.fixed_dictionaries({
    "patient_id": st.sampled_from(["A", "B", "C", None]),
    "date_facturation": st.sampled_from([dt.datetime(2025, 1, 1), dt.datetime(2025, 7, 1), None]),
    "montant_facture": st.sampled_from([Decimal("10.00"), Decimal("-1.00"), None]),
    "montant_paye": st.sampled_from([Decimal("0.00"), Decimal("20.00"), None]),
    "date_paiement": st.sampled_from([dt.datetime(2024, 12, 1), dt.datetime(2025, 3, 1), None]),
    "etablissement_id": st.sampled_from(["E1", None]),
})


def _silver(spark, rows):
    base = {f.name: None for f in SILVER.fields}
    return spark.createDataFrame([{**base, **r} for r in rows], SILVER)


def _lt(a, b):
    return a is not None and b is not None and a < b


@SETTINGS
@given(st.lists(row_st, min_size=1, max_size=40))
def test_quality_counts_equal_python(spark, rows):
    r = quality.quality_report(_silver(spark, rows), NOW).first().asDict()
    keys = Counter((x["patient_id"], x["date_facturation"], x["montant_facture"]) for x in rows)
    assert r["total_rows"] == len(rows)
    assert r["duplicates"] == sum(c - 1 for c in keys.values())
    assert r["missing_patient_id"] == sum(x["patient_id"] is None for x in rows)
    assert r["negative_amounts"] == sum(_lt(x["montant_facture"], Decimal(0)) for x in rows)
    assert r["future_dates"] == sum(_lt(NOW, x["date_facturation"]) for x in rows)
    assert r["incoherent_amounts"] == sum(_lt(x["montant_facture"], x["montant_paye"]) for x in rows)
    assert r["incoherent_dates"] == sum(_lt(x["date_paiement"], x["date_facturation"]) for x in rows)


def _staging(spark, rows):
    base = {f.name: None for f in STAGING.fields}
    return spark.createDataFrame([{**base, **r} for r in rows], STAGING)


stg_st = st.lists(st.tuples(st.sampled_from(["P1", "P2", "P3"]), st.sampled_from(["x", "y", "z"]),
                            st.integers(1, 3)), min_size=1, max_size=30)


@SETTINGS
@given(stg_st, st.integers(1, 6))
def test_first_wins_independent_of_partitioning(spark, data, parts):
    rows = [{"staging_id": i + 1, "patient_id": p, "patient_nom": n, "etablissement_id": "E",
             "date_facturation": dt.date(2025, 1, d), "montant_facture": Decimal(d)} for i, (p, n, d) in
            enumerate(data)]
    st_df = _staging(spark, rows)
    a = {r.patient_id_naturel: (r.patient_key, r.nom) for r in build_dims(st_df, NOW)[0].patient.collect()}
    b = {r.patient_id_naturel: (r.patient_key, r.nom)
         for r in build_dims(st_df.repartition(parts), NOW)[0].patient.collect()}
    assert a == b
    first = {}
    for r in rows:
        first.setdefault(r["patient_id"], (r["staging_id"], r["patient_nom"]))
    assert a == first


@SETTINGS
@given(stg_st)
def test_second_identical_load_inserts_nothing(spark, data):
    rows = [{"staging_id": i + 1, "patient_id": p, "patient_nom": n, "etablissement_id": "E",
             "date_facturation": dt.date(2025, 1, d), "montant_facture": Decimal(d)} for i, (p, n, d) in
            enumerate(data)]
    st_df = _staging(spark, rows)
    dims, _ = build_dims(st_df, NOW)
    fact = build_fact(st_df, dims, NOW)
    assert fact.count() == len(rows)                      # duplicates in one batch all load
    again = _staging(spark, [{**r, "staging_id": r["staging_id"] + 1000} for r in rows])
    dims2, _ = build_dims(again, NOW, existing=dims)
    assert build_fact(again, dims2, NOW, fact_snapshot=fact).count() == 0


@SETTINGS
@given(st.lists(st.integers(0, 20), min_size=1, max_size=5))
def test_union_keeps_every_row(spark, sizes):
    frames = [_silver(spark, [{"patient_id": f"p{i}"}] * n) for i, n in enumerate(sizes)]
    assert union_sources(frames).count() == sum(sizes)
