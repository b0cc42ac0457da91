"""Collection (relance) marts M1, M2, M6."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.functions import bands
from billstar.functions.derived import days_between
from billstar.operators.dimensions import Dims
from billstar.operators.views import star


def relance(fact: DataFrame, dims: Dims, as_of, overdue_days: int = 30,
            amount_limit: float = 5000.0, age_limit: int = 60, sort: bool = True) -> DataFrame:
    """Unpaid invoices older than ``overdue_days`` at ``as_of``, with a
    collection priority (invoice grain, 13 columns)."""
    age = days_between(as_of, F.col("d.date_complete"))
    rows = (star(fact, dims)
            .where((F.col("f.montant_impaye") > 0) & (age > overdue_days))
            .select(
                F.col("f.fact_id").alias("fact_id"),
                F.col("p.nom").alias("patient_nom"),
                F.col("p.prenom").alias("patient_prenom"),
                F.col("e.nom_etablissement").alias("nom_etablissement"),
                F.col("s.service_nom").alias("service_nom"),
                F.col("f.montant_facture").alias("montant_facture"),
                F.col("f.montant_paye").alias("montant_paye"),
                F.col("f.montant_impaye").alias("montant_impaye"),
                age.alias("delai_jours"),
                F.col("f.statut_paiement").alias("statut_paiement"),
                F.col("f.anomaly_score").alias("anomaly_score"),
                bands.priority(F.col("f.anomaly_score"), F.col("f.montant_impaye"), age,
                               amount_limit, age_limit).alias("priorite"),
                F.col("d.date_complete").alias("date_facturation"),
            ))
    if not sort:
        return rows
    # Stored order is not kept by a file table: readers sort (O3, T9 ranks 1,2,3,3).
    return rows.orderBy(bands.priority_rank(F.col("anomaly_score"), F.col("montant_impaye"), amount_limit),
                        F.col("montant_impaye").desc_nulls_first(), F.col("fact_id"))


def relance_patient(fact: DataFrame, dims: Dims, as_of, overdue_days: int = 30,
                    amount_limit: float = 5000.0, age_limit: int = 60) -> DataFrame:
    """Per-patient rollup of the collection list: total and count of
    unpaid overdue invoices, most urgent priority."""
    age = days_between(as_of, F.col("d.date_complete"))
    pr = bands.priority(F.col("f.anomaly_score"), F.col("f.montant_impaye"), age, amount_limit, age_limit)
    rank = F.when(pr == bands.URGENT, 1).when(pr == bands.PRIORITAIRE, 2).when(pr == bands.IMPORTANT, 3).otherwise(4)
    rows = (star(fact, dims)
            .where((F.col("f.montant_impaye") > 0) & (age > overdue_days))
            .select(F.col("p.patient_id_naturel").alias("patient_id_naturel"),
                    F.col("p.nom").alias("patient_nom"), F.col("p.prenom").alias("patient_prenom"),
                    F.col("f.montant_impaye").alias("montant_impaye"), rank.alias("_rank")))
    names = F.array(*[F.lit(x) for x in (bands.URGENT, bands.PRIORITAIRE, bands.IMPORTANT, bands.STANDARD)])
    return (rows.groupBy("patient_id_naturel", "patient_nom", "patient_prenom")
            .agg(F.sum("montant_impaye").alias("total_impaye"),
                 F.count(F.lit(1)).alias("nb_factures_impayees"),
                 F.min("_rank").alias("_best"))
            .withColumn("priorite_max", F.element_at(names, F.col("_best")))
            .drop("_best"))


def relance_urgent(mart: DataFrame) -> DataFrame:
    """M6: the URGENT slice of the mart."""
    return mart.where(F.col("priorite") == bands.URGENT)
