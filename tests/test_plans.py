"""Plans of the repaired operators: what is shuffled, scanned and joined,
and in which order."""

from __future__ import annotations

import re

import pytest

from billstar.operators import constraints, quality, reports
from billstar.plans.model import from_driver_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return from_driver_tables(spark, SF)


@pytest.fixture()
def plan(spark):
    """The plan with no side small enough to be broadcast by size."""
    def text(make):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return make()._jdf.queryExecution().optimizedPlan().toString(), \
                make()._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return text


@pytest.mark.parametrize("report", ["top_delays", "anomaly_clients"])
def test_top_k_is_taken_before_the_joins(model, plan, report):
    logical, physical = plan(lambda: getattr(reports, report)(model.fact, model.dims))
    lines = logical.splitlines()
    limit = max(i for i, line in enumerate(lines) if "LocalLimit" in line or "GlobalLimit" in line)
    assert all(i < limit for i, line in enumerate(lines) if re.search(r"\bJoin\b", line))
    assert "Exchange hashpartitioning" not in physical


def test_single_checks_shuffle_no_data_key(model, plan):
    for name in ("negative_amounts", "future_dates", "incoherent_amounts", "incoherent_dates"):
        _, physical = plan(lambda n=name: quality.counters(model.silver, model.opts.timestamp, [n]))
        assert "hashpartitioning" not in physical and physical.count("Exchange") == 1


def test_duplicates_shuffle_a_count_and_the_keys_only(model, plan):
    _, physical = plan(lambda: quality.duplicates(model.silver))
    keyed = [line for line in physical.splitlines() if "keys=[patient_id" in line]
    assert keyed and all("count" in line and "montant_paye" not in line for line in keyed)


def test_foreign_keys_scan_the_fact_once(model, plan):
    _, physical = plan(lambda: constraints.fk_orphans(model.fact, model.dims))
    assert len(re.findall(r"FileScan parquet \[fact_id", physical)) == 1
