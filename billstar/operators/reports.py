"""Ad-hoc billing reports.

Top-k reports sort on a total order (a unique id breaks ties), so the k
rows are the same on every engine. The k rows are taken from the fact
first (TakeOrderedAndProject: per-task top k, then a merge of k rows per
task); the dimensions are joined to them afterwards, as the fact's foreign
keys hold by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.functions import bands
from billstar.operators.dimensions import Dims
from billstar.operators.views import recovery_pct


def factures_etablissement(fact: DataFrame, dims: Dims) -> DataFrame:
    f = fact.join(dims.etablissement.select("etablissement_key", "nom_etablissement"), "etablissement_key")
    return (f.groupBy("nom_etablissement")
            .agg(F.count(F.lit(1)).alias("nb_factures"),
                 F.sum("montant_facture").alias("total_facture"),
                 F.sum("montant_impaye").alias("total_impaye"))
            .orderBy(F.col("total_impaye").desc_nulls_first()))


def ca_etablissement(fact: DataFrame, dims: Dims) -> DataFrame:
    f = fact.join(dims.etablissement.select("etablissement_key", "nom_etablissement"), "etablissement_key")
    return f.groupBy("nom_etablissement").agg(F.sum("montant_facture").alias("ca_total"))


def taux_service(fact: DataFrame, dims: Dims) -> DataFrame:
    """Payment rate per service; invoices without a service are excluded
    (inner join), lowest rate first, NULL rates last."""
    f = fact.join(dims.service.select("service_key", "service_nom"), "service_key")
    return (f.groupBy("service_nom")
            .agg(F.count(F.lit(1)).alias("nb_factures"),
                 F.sum("montant_facture").alias("total_facture"),
                 F.sum("montant_paye").alias("total_paye"),
                 recovery_pct(F.sum("montant_paye"), F.sum("montant_facture")).alias("taux_paiement_pct"))
            .orderBy(F.col("taux_paiement_pct").asc_nulls_last()))


def _described(top: DataFrame, dims: Dims) -> DataFrame:
    """A bounded number of fact rows (a report's k) with patient, facility
    and date; they are the broadcast side of every join, so no dimension is shuffled."""
    for dim, key, *columns in ((dims.patient, "patient_key", "nom", "prenom"),
                               (dims.etablissement, "etablissement_key", "nom_etablissement"),
                               (dims.date, "date_key", "date_complete")):
        top = dim.select(key, *columns).join(F.broadcast(top), key)
    return top


def top_delays(fact: DataFrame, dims: Dims, k: int = 10) -> DataFrame:
    """Longest payment delays; payment date = billing date + delay."""
    order = [F.col("delai_paiement_jours").desc(), F.col("fact_id")]
    top = (fact.where(F.col("delai_paiement_jours").isNotNull())
           .select("fact_id", "patient_key", "etablissement_key", "date_key", "delai_paiement_jours", "montant_impaye")
           .orderBy(*order).limit(k))
    return (_described(top, dims).orderBy(*order)
            .select(F.concat(F.col("nom"), F.lit(" "), F.col("prenom")).alias("patient"),
                    "nom_etablissement",
                    F.col("date_complete").alias("date_facturation"),
                    F.date_add(F.col("date_complete"), F.col("delai_paiement_jours")).alias("date_paiement"),
                    "delai_paiement_jours", "montant_impaye"))


def tendance_mensuelle(fact: DataFrame, dims: Dims) -> DataFrame:
    f = fact.join(dims.date.select("date_key", "annee", "mois", "nom_mois"), "date_key")
    return (f.groupBy("annee", "mois", "nom_mois")
            .agg(F.count(F.lit(1)).alias("nb_factures"),
                 F.sum("montant_facture").alias("ca_total"),
                 F.avg("montant_impaye").alias("montant_impaye_moyen"))
            .orderBy("annee", "mois")
            .select("annee", "nom_mois", "nb_factures", "ca_total", "montant_impaye_moyen"))


def anomaly_clients(fact: DataFrame, dims: Dims, k: int = 20, threshold: float = -0.1) -> DataFrame:
    """Most anomalous invoices by decision value (score minus threshold)."""
    order = [F.col("anomaly_decision").asc(), F.col("fact_id")]
    top = (fact.where(F.col("anomaly_decision") < threshold)
           .select("fact_id", "patient_key", "etablissement_key", "date_key", "montant_impaye", "anomaly_score",
                   "anomaly_decision")
           .orderBy(*order).limit(k))
    return (_described(top, dims).orderBy(*order)
            .select("nom", "prenom", "montant_impaye", "anomaly_score", "anomaly_decision",
                    F.col("date_complete").alias("date_facturation"), "nom_etablissement"))


def anomaly_count(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if(F.col("anomaly_score") == -1).alias("nb_anomalies"))


def bandes_anomalie(fact: DataFrame) -> DataFrame:
    band = bands.anomaly_band(F.col("anomaly_decision"))
    return (fact.where(F.col("montant_impaye") > 0)
            .groupBy(band.alias("categorie_anomalie"))
            .agg(F.count(F.lit(1)).alias("nb_factures"),
                 F.avg("montant_impaye").alias("montant_impaye_moyen"))
            .orderBy(F.col("montant_impaye_moyen").desc_nulls_first()))


def features_top(fact: DataFrame, k: int = 50) -> DataFrame:
    return (fact.where(F.col("montant_impaye") > 0)
            .orderBy(F.col("anomaly_decision").asc_nulls_last(), F.col("fact_id"))
            .limit(k)
            .select("fact_id", "montant_impaye", "delai_paiement_jours", "montant_facture",
                    "anomaly_score", "anomaly_decision",
                    bands.anomaly_status(F.col("anomaly_decision")).alias("statut")))


def relance_priorite(mart: DataFrame) -> DataFrame:
    """Mart by priority (invoice grain: the sum is of unpaid amounts)."""
    return (mart.groupBy("priorite")
            .agg(F.count(F.lit(1)).alias("nb_patients"),
                 F.sum("montant_impaye").alias("montant_total"))
            .orderBy(bands.priority_name_rank(F.col("priorite")), "priorite"))
