"""Dimension builds (G10-G14) with insert-if-absent semantics.

Surrogate keys need no global sort and no row numbering: a member's key
is the lowest ``staging_id`` that carries its natural key. Staging ids are
unique, so keys are unique; they are a pure function of the data, so a
recomputed task or a replayed batch yields the same keys. The first-wins
attributes come from that same row (``min_by``). Both are ordinary
aggregates: Spark combines them map-side, so a natural key that holds a
third of all rows is reduced to one partial row per task before the
shuffle. The date dimension uses the smart key yyyymmdd instead.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.functions.calendar import calendar_columns
from billstar.schema import DIM_DATE, DIM_ETABLISSEMENT, DIM_PATIENT, DIM_SERVICE, conform

VALID_TO_OPEN = dt.datetime(9999, 12, 31)


@dataclass
class Dims:
    patient: DataFrame
    etablissement: DataFrame
    date: DataFrame
    service: DataFrame


def _conform(df: DataFrame, schema) -> DataFrame:
    return conform(df, schema)


def _first_wins(staging: DataFrame, natural: str, attrs: list[str], key: str) -> DataFrame:
    first = F.min_by(F.struct(*[F.col(a) for a in attrs]), F.col("staging_id")) if attrs else None
    aggs = [F.min("staging_id").alias(key)]
    if first is not None:
        aggs.append(first.alias("_first"))
    out = staging.where(F.col(natural).isNotNull()).groupBy(natural).agg(*aggs)
    for a in attrs:
        out = out.withColumn(a, F.col(f"_first.{a}"))
    return out.drop("_first") if attrs else out


def _absent(members: DataFrame, existing: DataFrame | None, member_col: str, dim_col: str) -> DataFrame:
    """Keep members whose natural key is not in the existing dimension
    (ON CONFLICT DO NOTHING: existing rows are never updated)."""
    if existing is None:
        return members
    known = existing.select(F.col(dim_col).alias(member_col))
    return members.join(known, member_col, "left_anti")


def new_patients(staging: DataFrame, run_ts, existing: DataFrame | None = None) -> DataFrame:
    m = _first_wins(staging, "patient_id", ["patient_nom", "patient_prenom"], "patient_key")
    m = _absent(m, existing, "patient_id", "patient_id_naturel")
    ts = F.lit(run_ts).cast("timestamp")
    return _conform(m.select(
        "patient_key",
        F.col("patient_id").alias("patient_id_naturel"),
        F.col("patient_nom").alias("nom"),
        F.col("patient_prenom").alias("prenom"),
        ts.alias("valid_from"),
        F.lit(VALID_TO_OPEN).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    ), DIM_PATIENT)


def new_etablissements(staging: DataFrame, run_ts, existing: DataFrame | None = None) -> DataFrame:
    m = _first_wins(staging, "etablissement_id", ["etablissement_nom"], "etablissement_key")
    m = _absent(m, existing, "etablissement_id", "etablissement_id_naturel")
    ts = F.lit(run_ts).cast("timestamp")
    return _conform(m.select(
        "etablissement_key",
        F.col("etablissement_id").alias("etablissement_id_naturel"),
        F.col("etablissement_nom").alias("nom_etablissement"),
        F.lit(None).alias("ville"), F.lit(None).alias("region"), F.lit(None).alias("type_etablissement"),
        ts.alias("created_at"), ts.alias("updated_at"),
    ), DIM_ETABLISSEMENT)


def new_services(staging: DataFrame, run_ts, existing: DataFrame | None = None) -> DataFrame:
    m = _first_wins(staging, "service", [], "service_key")
    m = _absent(m, existing, "service", "service_code")
    ts = F.lit(run_ts).cast("timestamp")
    return _conform(m.select(
        "service_key",
        F.col("service").alias("service_code"),
        F.col("service").alias("service_nom"),
        F.lit(None).alias("categorie"), F.lit(None).alias("departement"),
        ts.alias("created_at"), ts.alias("updated_at"),
    ), DIM_SERVICE)


def new_dates(staging: DataFrame, run_ts, existing: DataFrame | None = None) -> DataFrame:
    m = (staging.where(F.col("date_facturation").isNotNull())
         .select(F.col("date_facturation").cast("date").alias("d")).distinct())
    m = _absent(m, existing, "d", "date_complete")
    cols = calendar_columns(F.col("d"))
    cols["created_at"] = F.lit(run_ts).cast("timestamp")
    return _conform(m.select(*[c.alias(n) for n, c in cols.items()]), DIM_DATE)


def build_dims(staging: DataFrame, run_ts, existing: Dims | None = None) -> tuple[Dims, Dims]:
    """(full dimensions, new members only) after one batch."""
    ex = existing
    new = Dims(
        patient=new_patients(staging, run_ts, ex.patient if ex else None),
        etablissement=new_etablissements(staging, run_ts, ex.etablissement if ex else None),
        date=new_dates(staging, run_ts, ex.date if ex else None),
        service=new_services(staging, run_ts, ex.service if ex else None),
    )
    if ex is None:
        return new, new
    full = Dims(
        patient=ex.patient.unionByName(new.patient),
        etablissement=ex.etablissement.unionByName(new.etablissement),
        date=ex.date.unionByName(new.date),
        service=ex.service.unionByName(new.service),
    )
    return full, new
