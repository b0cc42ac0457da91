"""Registered queries: one callable (spark, sf_dir) -> DataFrame per
operator of the inventory. Each reads the driver tables whole.

Outputs are presented with engine-neutral types: stored DECIMAL amounts
are cast to DOUBLE at the very end (the stored tables keep DECIMAL(12,2)).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.operators import marts, reports, views
from billstar.operators.fact import lookup_keys
from billstar.plans.model import from_driver_tables, two_batches

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """DECIMAL -> DOUBLE for engine-neutral comparison; others unchanged."""
    def q(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"
    return df.selectExpr(*[
        f"CAST({q(f.name)} AS DOUBLE) AS {q(f.name)}" if isinstance(f.dataType, T.DecimalType) else q(f.name)
        for f in df.schema.fields
    ])


# --------------------------------------------------------------------- views
@query("view_ca_mensuel")
def q_view_ca_mensuel(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(views.ca_mensuel(m.fact, m.dims))


@query("view_stats_etablissement")
def q_view_stats_etablissement(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(views.stats_etablissement(m.fact, m.dims))


@query("view_facturation_complete")
def q_view_facturation_complete(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(views.facturation_complete(m.fact, m.dims))


# --------------------------------------------------------------------- marts
@query("mart_relance")
def q_mart_relance(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(marts.relance(m.fact, m.dims, m.opts.as_of))


@query("mart_relance_patient")
def q_mart_relance_patient(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(marts.relance_patient(m.fact, m.dims, m.opts.as_of))


@query("flt_overdue")
def q_flt_overdue(spark, sf):
    m = from_driver_tables(spark, sf)
    age = F.datediff(F.lit(m.opts.as_of), F.col("date_complete"))
    return (m.fact.join(m.dims.date.select("date_key", "date_complete"), "date_key")
            .where(age > m.opts.overdue_days)
            .select("fact_id", age.alias("delai_jours")))


# ------------------------------------------------------------------- reports
@query("rep_factures_etablissement")
def q_rep_factures_etablissement(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(reports.factures_etablissement(m.fact, m.dims))


@query("rep_ca_etablissement")
def q_rep_ca_etablissement(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(reports.ca_etablissement(m.fact, m.dims))


@query("rep_taux_service")
def q_rep_taux_service(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(reports.taux_service(m.fact, m.dims))


@query("rep_top_delays")
def q_rep_top_delays(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(reports.top_delays(m.fact, m.dims))


@query("rep_tendance_mensuelle")
def q_rep_tendance_mensuelle(spark, sf):
    m = from_driver_tables(spark, sf)
    out = reports.tendance_mensuelle(m.fact, m.dims)
    return present(out.withColumn("montant_impaye_moyen", F.round("montant_impaye_moyen", 6)))


@query("rep_relance_priorite")
def q_rep_relance_priorite(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(reports.relance_priorite(marts.relance(m.fact, m.dims, m.opts.as_of, sort=False)))


@query("agg_count")
def q_agg_count(spark, sf):
    m = from_driver_tables(spark, sf)
    f = m.fact.agg(F.count(F.lit(1)).alias("n")).select(F.lit("fact_facturation").alias("table_name"), "n")
    p = m.dims.patient.agg(F.count(F.lit(1)).alias("n")).select(F.lit("dim_patient").alias("table_name"), "n")
    return f.unionByName(p)


# ---------------------------------------------------------------- dimensions
@query("dim_patient")
def q_dim_patient(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.dims.patient.select("patient_key", "patient_id_naturel", "nom", "prenom")


@query("dim_patient_defaults")
def q_dim_patient_defaults(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.dims.patient.select("patient_key", "valid_to", "is_current",
                                 (F.col("valid_from") == F.col("created_at")).alias("valid_from_is_load"))


@query("dim_etablissement")
def q_dim_etablissement(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.dims.etablissement.select("etablissement_key", "etablissement_id_naturel", "nom_etablissement",
                                       "ville", "region", "type_etablissement")


@query("dim_service")
def q_dim_service(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.dims.service.select("service_key", "service_code", "service_nom", "categorie", "departement")


@query("dim_date")
def q_dim_date(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.dims.date.select("date_key", "date_complete", "annee", "mois", "jour", "trimestre")


@query("dim_date_calendar")
def q_dim_date_calendar(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.dims.date.select("date_key", "semaine", "jour_semaine", "nom_jour", "nom_mois", "est_weekend",
                              "est_jour_ferie", "annee_fiscale", "trimestre_fiscal")


# --------------------------------------------------------------------- facts
@query("fact_key_lookup")
def q_fact_key_lookup(spark, sf):
    m = from_driver_tables(spark, sf)
    return lookup_keys(m.staging, m.dims).select(
        "staging_id", "patient_key", "etablissement_key", "date_key", "service_key")


@query("fact_build")
def q_fact_build(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(m.fact.drop("created_at", "source_file", "anomaly_decision"))


@query("fact_incremental_anti")
def q_fact_incremental_anti(spark, sf):
    tb = two_batches(from_driver_tables(spark, sf))
    return present(tb.new_fact_b.select("fact_id", "patient_key", "date_key", "montant_facture"))


@query("dim_insert_absent")
def q_dim_insert_absent(spark, sf):
    tb = two_batches(from_driver_tables(spark, sf))
    return tb.new_dims_b.patient.select("patient_key", "patient_id_naturel", "nom", "prenom")


# --------------------------------------------------------- filters, loading
@query("flt_null_date")
def q_flt_null_date(spark, sf):
    from billstar.operators.loading import drop_null_billing_date
    m = from_driver_tables(spark, sf)
    return present(drop_null_billing_date(m.silver).select("staging_id", "date_facturation", "montant_facture"))


@query("flt_incoherent_dates")
def q_flt_incoherent_dates(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(m.valid.select("staging_id", "date_facturation", "date_paiement", "delai_paiement_jours"))


@query("flt_rejects")
def q_flt_rejects(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.rejects.select("staging_id", "reject_reason", "delai_paiement_jours")


@query("snk_staging_append")
def q_snk_staging_append(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(m.staging.drop("load_timestamp", "source_file"))


@query("drv_impaye")
def q_drv_impaye(spark, sf):
    m = from_driver_tables(spark, sf)
    return present(m.silver.select("staging_id", "montant_facture", "montant_paye", "montant_impaye"))


@query("drv_delai")
def q_drv_delai(spark, sf):
    m = from_driver_tables(spark, sf)
    return m.silver.select("staging_id", "delai_paiement_jours")


def queries() -> dict[str, QueryFn]:
    # Import side-effect modules that register further queries.
    from billstar.plans import catalog_ml, catalog_more, catalog_runs, catalog_sources  # noqa: F401
    return dict(REGISTRY)
