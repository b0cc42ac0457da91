"""Fact build (J1-J4) and score overlay.

``fact_id`` is the staging row's id: each staging row yields at most one
fact (every dimension is unique on its natural key), so the id is unique
without any global numbering, and stable under recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.operators.dimensions import Dims

FACT_DEDUP_KEYS = ["patient_key", "date_key", "montant_facture"]


def lookup_keys(staging: DataFrame, dims: Dims) -> DataFrame:
    """Natural -> surrogate keys: three inner lookups (rows with a missing
    patient, facility or date drop) and a left lookup of the nullable
    service. The patient dimension grows with the data and is joined by
    shuffle (AQE splits a hot patient's partition); facility, date and
    service are small and become broadcast joins once their measured size
    is under the broadcast threshold."""
    p = dims.patient.select(F.col("patient_id_naturel").alias("patient_id"), "patient_key")
    e = dims.etablissement.select(F.col("etablissement_id_naturel").alias("etablissement_id"), "etablissement_key")
    d = dims.date.select(F.col("date_complete").alias("date_facturation"), "date_key")
    s = dims.service.select(F.col("service_code").alias("service"), "service_key")
    return (staging
            .join(p, "patient_id", "inner")
            .join(e, "etablissement_id", "inner")
            .join(d, "date_facturation", "inner")
            .join(s, "service", "left"))


def not_already_loaded(candidates: DataFrame, fact_snapshot: DataFrame | None, buckets: int | None = None) -> DataFrame:
    """NOT EXISTS against the fact as it was before this insert, on
    (patient_key, date_key, montant_facture): duplicates inside one batch
    all pass, a later batch is suppressed against them. ``buckets``: the
    snapshot is stored in so many buckets of these keys; the candidates are
    dealt alike and the snapshot is read in place."""
    if fact_snapshot is None:
        return candidates
    # distinct keys: a key repeated many times in the fact is reduced
    # map-side, and the aggregate's hash partitioning on the three keys is
    # reused by the join (no extra shuffle)
    seen = fact_snapshot.select(*FACT_DEDUP_KEYS).distinct()
    if buckets:
        # an anti-join would be moved below the repartition, and then shuffle both sides
        found = candidates.repartition(buckets, *FACT_DEDUP_KEYS).join(
            seen.withColumn("_loaded", F.lit(True)), FACT_DEDUP_KEYS, "left")
        return found.where(F.col("_loaded").isNull()).drop("_loaded")
    return candidates.join(seen, FACT_DEDUP_KEYS, "left_anti")


def build_fact(staging: DataFrame, dims: Dims, run_ts, fact_snapshot: DataFrame | None = None,
               buckets: int | None = None) -> DataFrame:
    """New fact rows of one batch."""
    rows = not_already_loaded(lookup_keys(staging, dims), fact_snapshot, buckets)
    ts = F.lit(run_ts).cast("timestamp")
    return rows.select(
        F.col("staging_id").cast("bigint").alias("fact_id"),
        *[F.col(c).cast("bigint").alias(c) for c in ("patient_key", "etablissement_key", "date_key", "service_key")],
        F.col("montant_facture").cast("decimal(12,2)"),
        F.col("montant_paye").cast("decimal(12,2)"),
        F.col("montant_impaye").cast("decimal(12,2)"),
        F.col("delai_paiement_jours").cast("int"),
        F.col("nombre_lignes").cast("int"),
        F.col("statut_paiement"),
        F.lit(None).cast("int").alias("anomaly_score"),
        F.lit(None).cast("double").alias("anomaly_decision"),
        F.col("source_file"),
        ts.alias("created_at"),
    )


def apply_scores(fact: DataFrame, scores: DataFrame | None, also: list[str] | None = None) -> DataFrame:
    """Overlay labels by fact_id: new score where one exists, else the old
    value (a skipped scoring run leaves earlier labels in place). ``also``
    names columns that both sides agree on, such as their partition."""
    also = also or []
    if scores is None:
        return fact
    s = scores.select("fact_id", *also,
                      F.col("anomaly_score").alias("_new_score"),
                      F.col("anomaly_decision").alias("_new_decision"))
    out = fact.join(s, ["fact_id", *also], "left")
    return out.select(*[
        F.coalesce(F.col("_new_score"), F.col("anomaly_score")).cast("int").alias("anomaly_score")
        if f.name == "anomaly_score" else
        F.coalesce(F.col("_new_decision"), F.col("anomaly_decision")).alias("anomaly_decision")
        if f.name == "anomaly_decision" else F.col(f.name)
        for f in fact.schema.fields
    ])
