"""Data-quality report (G2-G8) and blocking gate.

The row checks are one aggregate without a shuffle of the data: each task
sends one partial row. Only the duplicate check groups, on its three keys
and with nothing but a count beside them, combined map-side, so a key
holding a third of the rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL_FIELDS = ("patient_id", "montant_facture", "date_facturation", "etablissement_id")
DUPLICATE_KEYS = ("patient_id", "date_facturation", "montant_facture")


def _checks(now_ts) -> dict[str, Column]:
    c = {f"missing_{f}": F.col(f).isNull() for f in CRITICAL_FIELDS}
    c["negative_amounts"] = F.col("montant_facture") < 0
    c["future_dates"] = F.col("date_facturation") > F.lit(now_ts).cast("timestamp")
    c["incoherent_amounts"] = F.col("montant_paye") > F.col("montant_facture")
    c["incoherent_dates"] = F.col("date_paiement").isNotNull() & (F.col("date_paiement") < F.col("date_facturation"))
    return c


def counters(silver: DataFrame, now_ts, names=None) -> DataFrame:
    """One row: total_rows and the named row checks (all by default). A
    NULL comparison counts as false."""
    checks = _checks(now_ts)
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(checks[n]).alias(n) for n in (checks if names is None else names)])


def duplicates(silver: DataFrame) -> DataFrame:
    """One row: total_rows and the rows after the first of each duplicate
    key (NULLs equal)."""
    per_key = silver.groupBy(*DUPLICATE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def quality_report(silver: DataFrame, now_ts) -> DataFrame:
    """One row: total_rows, four missing counts, negative, future,
    duplicates, incoherent amounts and dates."""
    both = counters(silver, now_ts).unionByName(
        duplicates(silver).select("duplicates"), allowMissingColumns=True)
    order = ["total_rows", *[f"missing_{f}" for f in CRITICAL_FIELDS], "negative_amounts", "future_dates",
             "duplicates", "incoherent_amounts", "incoherent_dates"]
    return both.agg(*[F.max(c).cast("bigint").alias(c) for c in order])


def critical(report: DataFrame) -> Column:
    """Only these stop the run: missing patient id, missing amount, a
    negative amount. The other checks warn."""
    return (F.col("missing_patient_id") > 0) | (F.col("missing_montant_facture") > 0) | (F.col("negative_amounts") > 0)


def gate(report: DataFrame) -> DataFrame:
    """Report with the verdict as data."""
    return report.withColumn("critical", critical(report)).withColumn(
        "verdict", F.when(F.col("critical"), F.lit("FAIL")).otherwise(F.lit("PASS")))


class QualityGateError(ValueError):
    pass


def enforce_gate(report: DataFrame) -> dict:
    """Collect the single report row on the driver and raise on critical
    faults. Returns the report as a dict."""
    row = gate(report).first().asDict()
    if row["critical"]:
        raise QualityGateError(f"quality gate failed: {row}")
    return row


def report_long(report: DataFrame) -> DataFrame:
    """Long form (check, value) via stack."""
    names = [c for c in report.columns]
    expr = "stack({n}, {pairs}) as (check_name, value)".format(
        n=len(names), pairs=", ".join(f"'{c}', cast({c} as bigint)" for c in names))
    return report.selectExpr(expr)
