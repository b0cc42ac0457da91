"""Standardisation of one source's raw rows to the silver contract
(B1-B8) and consolidation of all sources (U1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.config import CANONICAL, SourceSpec
from billstar.functions.derived import payment_delay_days, unpaid_amount
from billstar.functions.parse import (ident, lenient_count_sql, lenient_decimal_sql, lenient_timestamp_sql,
                                      null_tokens_to_null_sql)
from billstar.schema import SILVER, conform


TEXT = ("patient_id", "patient_nom", "patient_prenom", "etablissement_id", "etablissement_nom", "service",
        "statut_paiement")


def rename(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Source names -> canonical names by name (column order does not
    matter); canonical columns the file lacks are NULL."""
    present = set(raw.columns)
    source_of = {c: s for s, c in spec.column_map.items()}
    exprs = [f"{ident(source_of[canon])} AS {canon}" if source_of.get(canon) in present
             else f"CAST(NULL AS STRING) AS {canon}" for canon in CANONICAL]
    if "source_file" in present:
        exprs.append("source_file")
    return raw.selectExpr(*exprs)


def coerce(renamed: DataFrame, spec: SourceSpec, run_ts) -> DataFrame:
    """Lenient typing plus derived and provenance columns. The typing is
    one SQL projection (parsed JVM-side in a single call)."""
    c = {name: ident(name) for name in CANONICAL}
    typed = [
        *[f"{null_tokens_to_null_sql(c[n])} AS {n}" for n in TEXT],
        f"{lenient_timestamp_sql(c['date_facturation'], spec.date_formats)} AS date_facturation",
        f"{lenient_timestamp_sql(c['date_paiement'], spec.date_formats)} AS date_paiement",
        f"{lenient_decimal_sql(c['montant_facture'])} AS montant_facture",
        f"{lenient_decimal_sql(c['montant_paye'])} AS montant_paye",
        f"{lenient_count_sql(c['nombre_lignes'])} AS nombre_lignes",
        "source_file" if "source_file" in renamed.columns else "CAST(NULL AS STRING) AS source_file",
    ]
    out = (renamed.selectExpr(*typed)
           .withColumn("montant_impaye", unpaid_amount(F.col("montant_facture"), F.col("montant_paye")))
           .withColumn("delai_paiement_jours", payment_delay_days(F.col("date_paiement"), F.col("date_facturation")))
           .withColumn("load_timestamp", F.lit(run_ts).cast("timestamp")))
    return conform(out, SILVER)


def standardize(raw: DataFrame, spec: SourceSpec, run_ts) -> DataFrame:
    """Whole standardiser for one source (B8): rename -> coerce."""
    return coerce(rename(raw, spec), spec, run_ts)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_and_standardize(spark, paths_df: DataFrame, run_ts, strict: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """(silver, malformed records) of the discovered raw files; None when
    no file is delimited text."""
    from billstar.sources.files import read_sources, split_malformed
    good, bad = [], []
    for spec, raw in read_sources(spark, paths_df, strict):
        rows, malformed = split_malformed(raw)
        good.append(standardize(rows, spec, run_ts))
        if malformed is not None:
            bad.append(malformed)
    silver = union_sources(good) if good else spark.createDataFrame([], SILVER)
    return silver, union_sources(bad) if bad else None


def build_silver(spark, paths_df: DataFrame, run_ts, strict: bool = True) -> DataFrame:
    """Discovered raw files -> one consolidated silver DataFrame."""
    return read_and_standardize(spark, paths_df, run_ts, strict)[0]
