"""Fixed schemas of the silver, staging and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

D12 = T.DecimalType(12, 2)

SILVER = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("patient_nom", T.StringType()),
    T.StructField("patient_prenom", T.StringType()),
    T.StructField("etablissement_id", T.StringType()),
    T.StructField("etablissement_nom", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("date_facturation", T.TimestampType()),
    T.StructField("montant_facture", D12),
    T.StructField("statut_paiement", T.StringType()),
    T.StructField("montant_paye", D12),
    T.StructField("date_paiement", T.TimestampType()),
    T.StructField("nombre_lignes", T.IntegerType()),
    T.StructField("montant_impaye", D12),
    T.StructField("delai_paiement_jours", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("load_timestamp", T.TimestampType()),
])

STAGING = T.StructType([
    T.StructField("staging_id", T.LongType()),
    T.StructField("patient_id", T.StringType()),
    T.StructField("patient_nom", T.StringType()),
    T.StructField("patient_prenom", T.StringType()),
    T.StructField("etablissement_id", T.StringType()),
    T.StructField("etablissement_nom", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("date_facturation", T.DateType()),
    T.StructField("date_paiement", T.DateType()),
    T.StructField("montant_facture", D12),
    T.StructField("montant_paye", D12),
    T.StructField("montant_impaye", D12),
    T.StructField("statut_paiement", T.StringType()),
    T.StructField("nombre_lignes", T.IntegerType()),
    T.StructField("delai_paiement_jours", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("load_timestamp", T.TimestampType()),
])

DIM_PATIENT = T.StructType([
    T.StructField("patient_key", T.LongType()),
    T.StructField("patient_id_naturel", T.StringType()),
    T.StructField("nom", T.StringType()),
    T.StructField("prenom", T.StringType()),
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("valid_to", T.TimestampType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

DIM_ETABLISSEMENT = T.StructType([
    T.StructField("etablissement_key", T.LongType()),
    T.StructField("etablissement_id_naturel", T.StringType()),
    T.StructField("nom_etablissement", T.StringType()),
    T.StructField("ville", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("type_etablissement", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.LongType()),
    T.StructField("date_complete", T.DateType()),
    T.StructField("annee", T.IntegerType()),
    T.StructField("mois", T.IntegerType()),
    T.StructField("jour", T.IntegerType()),
    T.StructField("trimestre", T.IntegerType()),
    T.StructField("semaine", T.IntegerType()),
    T.StructField("jour_semaine", T.IntegerType()),
    T.StructField("nom_jour", T.StringType()),
    T.StructField("nom_mois", T.StringType()),
    T.StructField("est_weekend", T.BooleanType()),
    T.StructField("est_jour_ferie", T.BooleanType()),
    T.StructField("annee_fiscale", T.IntegerType()),
    T.StructField("trimestre_fiscal", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])

DIM_SERVICE = T.StructType([
    T.StructField("service_key", T.LongType()),
    T.StructField("service_code", T.StringType()),
    T.StructField("service_nom", T.StringType()),
    T.StructField("categorie", T.StringType()),
    T.StructField("departement", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

FACT = T.StructType([
    T.StructField("fact_id", T.LongType()),
    T.StructField("patient_key", T.LongType()),
    T.StructField("etablissement_key", T.LongType()),
    T.StructField("date_key", T.LongType()),
    T.StructField("service_key", T.LongType()),
    T.StructField("montant_facture", D12),
    T.StructField("montant_paye", D12),
    T.StructField("montant_impaye", D12),
    T.StructField("delai_paiement_jours", T.IntegerType()),
    T.StructField("nombre_lignes", T.IntegerType()),
    T.StructField("statut_paiement", T.StringType()),
    T.StructField("anomaly_score", T.IntegerType()),
    T.StructField("anomaly_decision", T.DoubleType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

SCORES = T.StructType([
    T.StructField("fact_id", T.LongType()),
    T.StructField("anomaly_score", T.IntegerType()),
    T.StructField("anomaly_decision", T.DoubleType()),
])


def all_string(columns) -> T.StructType:
    """Schema that reads every raw field as text (keeps leading zeros)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def conform(df, schema: T.StructType, fill_missing: bool = False, defaults: dict | None = None):
    """``df`` projected onto ``schema``: columns in schema order, each cast
    to its type; with ``fill_missing``, absent columns get their default
    (SQL text) or become typed NULLs.
    One ``selectExpr`` (a single driver call) instead of one cast per
    column."""
    have = set(df.columns)
    exprs = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        if f.name in have:
            exprs.append(f"CAST({_ident(f.name)} AS {t}) AS {_ident(f.name)}")
        elif fill_missing:
            exprs.append(f"CAST({(defaults or {}).get(f.name, 'NULL')} AS {t}) AS {_ident(f.name)}")
        else:
            raise ValueError(f"column {f.name} missing")
    return df.selectExpr(*exprs)
