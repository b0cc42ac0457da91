"""Derived invoice measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unpaid_amount(billed: Column, paid: Column) -> Column:
    """billed - paid at scale 2 (exact decimal); NULL if either is NULL."""
    return (billed - paid).cast("decimal(12,2)")


def _time_of_day(ts: Column) -> Column:
    """Wall-clock time of day in seconds (with the fraction)."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def payment_delay_days(paid_at: Column, billed_at: Column) -> Column:
    """Whole elapsed 24 h periods between two wall-clock timestamps,
    floored, so 26 h early is -2 (not -1 as a calendar-day difference
    would say). Computed from calendar fields, so a daylight-saving change
    in the session time zone does not shift the result."""
    p, f = paid_at.cast("timestamp"), billed_at.cast("timestamp")
    days = F.datediff(F.to_date(p), F.to_date(f))
    return (days - F.when(_time_of_day(p) < _time_of_day(f), 1).otherwise(0)).cast("int")


def days_between(as_of, d: Column) -> Column:
    """Integer day count ``as_of - d`` on dates."""
    return F.datediff(F.lit(as_of).cast("date"), d)
