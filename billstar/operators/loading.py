"""Load filters (F1, F2, F9) and the typed staging cast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstar.schema import STAGING, conform

REASON_NULL_DATE = "date_facturation_null"
REASON_PAID_BEFORE_BILLED = "date_paiement_avant_facturation"


def null_billing_date() -> Column:
    return F.col("date_facturation").isNull()


def paid_before_billed() -> Column:
    """Non-null payment earlier than billing (compared before truncation)."""
    return F.col("date_paiement").isNotNull() & (F.col("date_paiement") < F.col("date_facturation"))


def reject_reason() -> Column:
    return (F.when(null_billing_date(), F.lit(REASON_NULL_DATE))
            .when(paid_before_billed(), F.lit(REASON_PAID_BEFORE_BILLED)))


def drop_null_billing_date(df: DataFrame) -> DataFrame:
    """F1."""
    return df.where(F.col("date_facturation").isNotNull())


def drop_paid_before_billed(df: DataFrame) -> DataFrame:
    """F2, written so NULL payment dates are kept."""
    return df.where(F.col("date_paiement").isNull() | (F.col("date_paiement") >= F.col("date_facturation")))


def split_rejects(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects). Both sides are plain filters over the same input,
    so each is one scan with the predicate pushed into it; rejects carry a
    reason instead of just a logged count (F9)."""
    valid = drop_paid_before_billed(drop_null_billing_date(silver))
    rejects = silver.withColumn("reject_reason", reject_reason()).where(F.col("reject_reason").isNotNull())
    return valid, rejects


def to_staging(valid: DataFrame) -> DataFrame:
    """Cast to the staging contract: timestamps truncate to dates; an
    absent paid amount defaults to 0, other absent columns to NULL."""
    return conform(valid, STAGING, fill_missing=True, defaults={"montant_paye": "0"})
