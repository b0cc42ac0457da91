"""CASE-style classifications used by the mart and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Collection priorities and the anomaly report labels.
URGENT, PRIORITAIRE, IMPORTANT, STANDARD = "URGENT", "PRIORITAIRE", "IMPORTANT", "STANDARD"
BAND_STRONG, BAND_MODERATE, BAND_WEAK, BAND_NORMAL = (
    "Anomalie forte", "Anomalie modérée", "Anomalie faible", "Normal",
)
ANOMALIE, NORMAL = "ANOMALIE", "NORMAL"


def priority(label: Column, unpaid: Column, age_days: Column,
             amount_limit: float = 5000.0, age_limit: int = 60) -> Column:
    """URGENT for an anomaly label, then amount, then age; a NULL label or
    amount falls through to the next rule. Comparisons are strict."""
    return (
        F.when(label == -1, F.lit(URGENT))
        .when(unpaid > F.lit(amount_limit), F.lit(PRIORITAIRE))
        .when(age_days > F.lit(age_limit), F.lit(IMPORTANT))
        .otherwise(F.lit(STANDARD))
    )


def priority_rank(label: Column, unpaid: Column, amount_limit: float = 5000.0) -> Column:
    """Sort rank of the mart: anomalies 1, large amounts 2, all others 3."""
    return F.when(label == -1, 1).when(unpaid > F.lit(amount_limit), 2).otherwise(3)


def priority_name_rank(p: Column) -> Column:
    return F.when(p == URGENT, 1).when(p == PRIORITAIRE, 2).otherwise(3)


def anomaly_band(score: Column) -> Column:
    return (
        F.when(score < -0.2, F.lit(BAND_STRONG))
        .when(score < -0.1, F.lit(BAND_MODERATE))
        .when(score < 0, F.lit(BAND_WEAK))
        .otherwise(F.lit(BAND_NORMAL))
    )


def anomaly_status(score: Column) -> Column:
    return F.when(score < -0.1, F.lit(ANOMALIE)).otherwise(F.lit(NORMAL))
