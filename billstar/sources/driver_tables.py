"""Silver rows derived from the TPC-H-like driver tables.

Invoice = order: patient = customer, facility = nation, service = order
priority, billing date = order date, payment date = last ship date of a
finished (F) or partly paid (P) order, paid amount all / half / nothing
by status, line count = number of line items. This gives every operator
a whole-table input that grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.functions.derived import payment_delay_days, unpaid_amount


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def driver_silver(spark: SparkSession, sf_dir: str, run_ts: dt.datetime,
                  with_staging_id: bool = True) -> DataFrame:
    """Silver-shaped rows (timestamps for dates), one per order.

    Plan: line items are pre-aggregated per order (partial + final hash
    aggregate), so the join to orders is one shuffle on the order key; the
    nation side is 25 rows and is broadcast by the planner."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", F.col("_metadata.file_name").alias("source_file"))
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n_lines")))

    billed = F.col("o_totalprice").cast("decimal(12,2)")
    status = F.col("o_orderstatus")
    paid = (F.when(status == "F", billed)
            .when(status == "P", (billed * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(12,2)"))
            .otherwise(F.lit(0).cast("decimal(12,2)")))
    paid_at = F.when(status.isin("F", "P"), F.col("last_ship"))

    # All three joins are left to the planner: a side is broadcast only
    # under the measured size threshold.
    joined = (orders
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
              .join(customer, F.col("o_custkey") == customer.c_custkey, "inner")
              .join(nation, F.col("c_nationkey") == nation.n_nationkey, "inner"))
    cols = []
    if with_staging_id:
        cols.append(F.col("o_orderkey").cast("bigint").alias("staging_id"))
    cols += [
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("c_name").alias("patient_nom"),
        F.col("c_mktsegment").alias("patient_prenom"),
        F.col("c_nationkey").cast("string").alias("etablissement_id"),
        F.col("n_name").alias("etablissement_nom"),
        F.col("o_orderpriority").alias("service"),
        F.col("o_orderdate").cast("timestamp").alias("date_facturation"),
        billed.alias("montant_facture"),
        status.alias("statut_paiement"),
        paid.alias("montant_paye"),
        paid_at.cast("timestamp").alias("date_paiement"),
        F.coalesce(F.col("n_lines"), F.lit(1)).cast("int").alias("nombre_lignes"),
        unpaid_amount(billed, paid).alias("montant_impaye"),
        payment_delay_days(paid_at, F.col("o_orderdate")).alias("delai_paiement_jours"),
        F.col("source_file"),
        F.lit(run_ts).cast("timestamp").alias("load_timestamp"),
    ]
    return joined.select(*cols)


def spoiled_silver(silver: DataFrame, as_of: dt.date) -> DataFrame:
    """The silver rows with faults planted by the remainder of staging_id,
    over the whole table: NULL dates, ids and services, negative amounts,
    overlong names, overpayments, future dates, wrong balances and
    duplicates (under a negative staging_id)."""
    sid = F.col("staging_id")

    def at(mod: int, rest: int):
        return sid % mod == rest

    billed = F.when(at(13, 5), -F.col("montant_facture")).otherwise(F.col("montant_facture"))
    paid = F.when(at(29, 6), F.col("montant_facture") * 2).otherwise(F.col("montant_paye"))
    unpaid = F.when(at(41, 10), F.col("montant_impaye") + 1).otherwise(billed - paid)
    date = F.when(at(11, 3), None).when(at(31, 8), F.lit(as_of).cast("timestamp") + F.expr("INTERVAL 100 DAYS"))
    out = silver.withColumns({
        "patient_id": F.when(~at(23, 4), F.col("patient_id")),
        "patient_nom": F.when(at(17, 7), F.repeat(F.col("patient_nom"), F.lit(12))).otherwise(F.col("patient_nom")),
        "service": F.when(~at(19, 2), F.col("service")),
        "date_facturation": F.when(at(11, 3) | at(31, 8), date).otherwise(F.col("date_facturation")),
        "montant_facture": billed.cast("decimal(12,2)"),
        "montant_paye": paid.cast("decimal(12,2)"),
        "montant_impaye": unpaid.cast("decimal(12,2)"),
    })
    return out.unionByName(out.where(at(37, 9)).withColumn("staging_id", -sid))


def region_of_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """facility id -> region key (0..4); used to spread rows over the five
    producer dialects without dropping any."""
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("etablissement_id"),
        F.col("n_regionkey").cast("int").alias("region_key"))
