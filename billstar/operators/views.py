"""The warehouse views (M3-M5) as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.operators.dimensions import Dims


def star(fact: DataFrame, dims: Dims) -> DataFrame:
    """Fact with its four dimensions: three inner joins, one left."""
    return (fact.alias("f")
            .join(dims.patient.alias("p"), F.col("f.patient_key") == F.col("p.patient_key"), "inner")
            .join(dims.etablissement.alias("e"), F.col("f.etablissement_key") == F.col("e.etablissement_key"), "inner")
            .join(dims.date.alias("d"), F.col("f.date_key") == F.col("d.date_key"), "inner")
            .join(dims.service.alias("s"), F.col("f.service_key") == F.col("s.service_key"), "left"))


def facturation_complete(fact: DataFrame, dims: Dims) -> DataFrame:
    """Denormalised invoice view, 24 columns."""
    return star(fact, dims).select(
        F.col("f.fact_id").alias("fact_id"),
        F.col("f.created_at").alias("date_creation_enregistrement"),
        F.col("p.patient_id_naturel").alias("patient_id_naturel"),
        F.col("p.nom").alias("patient_nom"),
        F.col("p.prenom").alias("patient_prenom"),
        F.col("e.etablissement_id_naturel").alias("etablissement_id_naturel"),
        F.col("e.nom_etablissement").alias("nom_etablissement"),
        F.col("e.ville").alias("etablissement_ville"),
        F.col("e.type_etablissement").alias("type_etablissement"),
        F.col("d.date_complete").alias("date_facturation"),
        F.col("d.annee").alias("annee"),
        F.col("d.mois").alias("mois"),
        F.col("d.trimestre").alias("trimestre"),
        F.col("d.nom_mois").alias("nom_mois"),
        F.col("s.service_nom").alias("service_nom"),
        F.col("s.categorie").alias("service_categorie"),
        F.col("f.montant_facture").alias("montant_facture"),
        F.col("f.montant_paye").alias("montant_paye"),
        F.col("f.montant_impaye").alias("montant_impaye"),
        F.col("f.delai_paiement_jours").alias("delai_paiement_jours"),
        F.col("f.nombre_lignes").alias("nombre_lignes"),
        F.col("f.statut_paiement").alias("statut_paiement"),
        F.col("f.anomaly_score").alias("anomaly_score"),
        F.col("f.source_file").alias("source_file"),
    )


def stats_etablissement(fact: DataFrame, dims: Dims) -> DataFrame:
    """Per facility name: counts, sums, rounded averages, anomaly count.
    Sorted by billed total, NULL first on DESC as in the reference DBMS."""
    f = fact.join(dims.etablissement.select("etablissement_key", "nom_etablissement"), "etablissement_key")
    return (f.groupBy("nom_etablissement")
            .agg(F.count(F.lit(1)).alias("nombre_factures"),
                 F.sum("montant_facture").alias("total_facture"),
                 F.sum("montant_paye").alias("total_paye"),
                 F.sum("montant_impaye").alias("total_impaye"),
                 F.round(F.avg("montant_facture"), 2).alias("montant_moyen_facture"),
                 F.round(F.avg("delai_paiement_jours"), 1).alias("delai_moyen_paiement_jours"),
                 F.count_if(F.col("anomaly_score") == -1).alias("nombre_anomalies"))
            .orderBy(F.col("total_facture").desc_nulls_first()))


def recovery_pct(paid_sum, billed_sum):
    return F.round(F.lit(100.0).cast("decimal(4,1)") * paid_sum / F.nullif(billed_sum, F.lit(0)), 2)


def ca_mensuel(fact: DataFrame, dims: Dims) -> DataFrame:
    """Monthly revenue and recovery rate (NULL when nothing was billed)."""
    f = fact.join(dims.date.select("date_key", "annee", "mois", "nom_mois"), "date_key")
    return (f.groupBy("annee", "mois", "nom_mois")
            .agg(F.count(F.lit(1)).alias("nombre_factures"),
                 F.sum("montant_facture").alias("ca_facture"),
                 F.sum("montant_paye").alias("ca_encaisse"),
                 F.sum("montant_impaye").alias("ca_impaye"),
                 recovery_pct(F.sum("montant_paye"), F.sum("montant_facture")).alias("taux_recouvrement_pct"))
            .orderBy(F.col("annee").desc_nulls_first(), F.col("mois").desc_nulls_first()))
