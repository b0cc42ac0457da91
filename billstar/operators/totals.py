"""Monthly and facility totals as mergeable partial aggregates.

A batch adds one row per month and facility that it has rows of. The views
add those rows up, so they read months x facilities rows for each batch, not the
fact. Averages are kept as sums and counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.operators.dimensions import Dims
from billstar.operators.views import recovery_pct

MONTH = T.StructField("mois_facturation", T.IntegerType())
SUM = T.DecimalType(22, 2)
GROUP = [MONTH, T.StructField("etablissement_key", T.LongType())]
FACT_TOTALS = T.StructType(GROUP + [
    T.StructField("factures", T.LongType()),
    T.StructField("facture", SUM), T.StructField("avec_montant", T.LongType()),
    T.StructField("paye", SUM), T.StructField("impaye", SUM),
    T.StructField("delai", T.LongType()), T.StructField("avec_delai", T.LongType()),
])
ANOMALY_TOTALS = T.StructType(GROUP + [T.StructField("anomalies", T.LongType())])


def fact_totals(fact: DataFrame) -> DataFrame:
    """The sums of fact rows by month and facility."""
    return fact.groupBy(*[f.name for f in GROUP]).agg(
        F.count(F.lit(1)).alias("factures"),
        F.sum("montant_facture").alias("facture"), F.count("montant_facture").alias("avec_montant"),
        F.sum("montant_paye").alias("paye"), F.sum("montant_impaye").alias("impaye"),
        F.sum("delai_paiement_jours").alias("delai"), F.count("delai_paiement_jours").alias("avec_delai"))


def anomaly_totals(fact: DataFrame) -> DataFrame:
    """The anomalies among labelled fact rows by month and facility."""
    return fact.where(F.col("anomaly_score") == -1).groupBy(*[f.name for f in GROUP]).agg(
        F.count(F.lit(1)).alias("anomalies"))


def _sum(column: str) -> F.Column:
    """A sum of sums, of the type that one sum over the rows has."""
    return F.sum(column).cast(FACT_TOTALS[column].dataType)


def stats_etablissement(totals: DataFrame, anomalies: DataFrame | None, dims: Dims) -> DataFrame:
    """The rows of :func:`views.stats_etablissement` from the totals."""
    rows = totals
    if anomalies is not None:
        rows = rows.unionByName(anomalies, allowMissingColumns=True)
    anomaly_count = F.coalesce(F.sum("anomalies"), F.lit(0)) if anomalies is not None else F.lit(0)
    names = dims.etablissement.select("etablissement_key", "nom_etablissement")
    return (rows.join(names, "etablissement_key").groupBy("nom_etablissement")
            .agg(F.sum("factures").alias("nombre_factures"),
                 _sum("facture").alias("total_facture"),
                 _sum("paye").alias("total_paye"),
                 _sum("impaye").alias("total_impaye"),
                 F.round((_sum("facture") / F.nullif(F.sum("avec_montant"), F.lit(0))).cast("decimal(16,6)"), 2)
                 .alias("montant_moyen_facture"),
                 F.round(F.sum("delai").cast("double") / F.nullif(F.sum("avec_delai"), F.lit(0)), 1)
                 .alias("delai_moyen_paiement_jours"),
                 anomaly_count.cast("bigint").alias("nombre_anomalies"))
            .orderBy(F.col("total_facture").desc_nulls_first()))


def ca_mensuel(totals: DataFrame, dims: Dims) -> DataFrame:
    """The rows of :func:`views.ca_mensuel` from the totals."""
    months = dims.date.select("annee", "mois", "nom_mois").distinct().withColumn(
        MONTH.name, F.col("annee") * 100 + F.col("mois"))
    return (totals.join(months, MONTH.name).groupBy("annee", "mois", "nom_mois")
            .agg(F.sum("factures").alias("nombre_factures"),
                 _sum("facture").alias("ca_facture"),
                 _sum("paye").alias("ca_encaisse"),
                 _sum("impaye").alias("ca_impaye"),
                 recovery_pct(_sum("paye"), _sum("facture")).alias("taux_recouvrement_pct"))
            .orderBy(F.col("annee").desc_nulls_first(), F.col("mois").desc_nulls_first()))
