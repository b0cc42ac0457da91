"""Lenient parsing and derived columns (T1, T2, T17, T21, bad values)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from billstar.config import DATE_FORMATS
from billstar.functions.derived import payment_delay_days, unpaid_amount
from billstar.functions.parse import lenient_count, lenient_decimal, lenient_timestamp


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr("v")).collect()]


def test_french_dates_day_first(spark):
    got = one_col(spark, ["05/01/2025", "25/11/2025", "31/02/2025", "", None],
                  lambda c: lenient_timestamp(c, DATE_FORMATS["etablissement1"]))
    assert got[0] == dt.datetime(2025, 1, 5)
    assert got[1] == dt.datetime(2025, 11, 25)
    assert got[2] is None and got[3] is None and got[4] is None


def test_iso_and_timestamp_dates(spark):
    got = one_col(spark, ["2025-03-04", "2025-03-04 13:05:09", "junk"],
                  lambda c: lenient_timestamp(c, DATE_FORMATS["etablissement5"]))
    assert got == [dt.datetime(2025, 3, 4), dt.datetime(2025, 3, 4, 13, 5, 9), None]


def test_bad_amounts_become_null(spark):
    got = one_col(spark, ["abc", "NaN", "inf", "1234.5", " 12 ", "", "1e3"], lenient_decimal)
    assert got[:3] == [None, None, None]
    assert float(got[3]) == 1234.5 and float(got[4]) == 12.0
    assert got[5] is None and float(got[6]) == 1000.0


def test_line_counts_default_and_truncate(spark):
    assert one_col(spark, ["", "x", "3.7", "NaN", "12", None], lenient_count) == [1, 1, 3, 1, 12, 1]


def test_delay_floors_elapsed_days(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 2, 10), dt.datetime(2025, 1, 1, 8)),      # 26 h early
         (dt.datetime(2025, 1, 1, 8), dt.datetime(2025, 1, 2, 7)),       # 23 h later
         (dt.datetime(2025, 1, 1), None)],
        "billed timestamp, paid timestamp")
    got = [r[0] for r in df.select(payment_delay_days(F.col("paid"), F.col("billed"))).collect()]
    assert got == [-2, 0, None]


def test_unpaid_is_exact_decimal(spark):
    df = spark.createDataFrame([("100.10", "0.20"), ("120", "100"), (None, "1")], "b string, p string")
    got = [r[0] for r in df.select(unpaid_amount(F.col("b").cast("decimal(12,2)"),
                                                 F.col("p").cast("decimal(12,2)"))).collect()]
    assert [None if g is None else str(g) for g in got] == ["99.90", "20.00", None]


def test_conform_orders_casts_and_fills(spark):
    import pytest
    from pyspark.sql import types as T

    from billstar.schema import conform
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("amt", T.DecimalType(12, 2)),
                           T.StructField("odd name", T.StringType())])
    df = spark.createDataFrame([("12.50", "3")], "amt string, n string")
    out = conform(df, schema, fill_missing=True)
    assert out.schema == schema
    assert [tuple(r) for r in out.collect()] == [(3, Decimal("12.50"), None)]
    with pytest.raises(ValueError):
        conform(df, schema)
