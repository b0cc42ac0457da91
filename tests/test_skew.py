"""A hot key holding a third of all rows: results stay whole and exact,
and every grouping combines map-side before its shuffle (no task ever
receives the hot group's rows unreduced)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from billstar.operators import quality
from billstar.operators.dimensions import build_dims, new_patients
from billstar.operators.fact import build_fact
from billstar.schema import SILVER, STAGING

TS = dt.datetime(2025, 6, 1)
N = 3000
HOT = N // 3


def _rows(spark, schema, date_type):
    """N rows; the first third belong to patient HOT with one identical
    (patient, date, amount) key, the rest to distinct patients."""
    df = spark.range(N).select(
        F.col("id").alias("staging_id"),
        F.when(F.col("id") < HOT, F.lit("HOT")).otherwise(F.concat(F.lit("P"), F.col("id").cast("string")))
         .alias("patient_id"),
        F.concat(F.lit("Nom"), F.col("id").cast("string")).alias("patient_nom"),
        F.lit("Pre").alias("patient_prenom"),
        (F.col("id") % 5).cast("string").alias("etablissement_id"),
        F.concat(F.lit("Clinique "), (F.col("id") % 5).cast("string")).alias("etablissement_nom"),
        F.lit("URGENCES").alias("service"),
        F.when(F.col("id") < HOT, F.lit(dt.date(2025, 1, 1)))
         .otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int")))
         .cast(date_type).alias("date_facturation"),
        F.lit(None).cast(date_type).alias("date_paiement"),
        F.when(F.col("id") < HOT, F.lit(Decimal("100.00")))
         .otherwise(F.col("id").cast("decimal(12,2)")).cast("decimal(12,2)").alias("montant_facture"),
        F.lit(Decimal("0.00")).cast("decimal(12,2)").alias("montant_paye"),
        F.when(F.col("id") < HOT, F.lit(Decimal("100.00")))
         .otherwise(F.col("id").cast("decimal(12,2)")).cast("decimal(12,2)").alias("montant_impaye"),
        F.lit("IMPAYE").alias("statut_paiement"),
        F.lit(1).alias("nombre_lignes"),
        F.lit(None).cast("int").alias("delai_paiement_jours"),
        F.lit("f.csv").alias("source_file"),
        F.lit(TS).cast("timestamp").alias("load_timestamp"),
    )
    # spread the hot key over every input partition, as a big scan would
    df = df.repartition(8, F.col("staging_id"))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _partial_before_shuffle(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    # with AQE the final plan is only known after running; the initial
    # plan already shows the map-side (partial) aggregate under the exchange
    return "partial_" in plan and "Exchange" in plan


def test_hot_patient_dims_and_fact_are_whole(spark):
    st = _rows(spark, STAGING, "date")
    dims, _ = build_dims(st, TS)
    p = dims.patient
    assert p.count() == N - HOT + 1
    hot = p.where(F.col("patient_id_naturel") == "HOT").first()
    assert hot.patient_key == 0 and hot.nom == "Nom0"          # first-wins: lowest staging id
    assert _partial_before_shuffle(new_patients(st, TS))
    fact = build_fact(st, dims, TS)
    assert fact.count() == N                                      # nothing dropped, capped or sampled
    assert fact.where(F.col("patient_key") == 0).count() == HOT
    # a second identical load is suppressed, hot key included
    assert build_fact(st, dims, TS, fact_snapshot=fact).count() == 0


def test_hot_duplicate_key_quality_counts(spark):
    sv = _rows(spark, SILVER, "timestamp")
    rep = quality.quality_report(sv, TS)
    r = rep.first().asDict()
    assert r["total_rows"] == N
    assert r["duplicates"] == HOT - 1                             # rows after the first of the hot key
    assert _partial_before_shuffle(rep)
