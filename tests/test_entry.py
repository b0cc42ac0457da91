"""Driver contract: entry(), queries(), oracle_sql(); oracle agreement of
core queries on the smallest driver tables."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "taux_recouvrement_pct" in df.columns


def test_registry_shape():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80 and len(o) >= 70


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.mark.parametrize("key", ["view_ca_mensuel", "view_stats_etablissement", "mart_relance",
                                 "fact_incremental_anti", "qc_report", "chk_fk_orphans", "rep_top_delays",
                                 "dim_date_calendar", "ml_scaled"])
def test_oracle_agreement(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[key](spark, SF)
    cols = sorted(df.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    res = con.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=str)
    assert srows == orows
