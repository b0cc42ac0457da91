"""The key table beside the fact, read in its buckets, and the totals that
the two totals views add up."""

from __future__ import annotations

import os
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from billstar.operators import views
from billstar.operators.fact import FACT_DEDUP_KEYS, not_already_loaded
from billstar.plans import runner
from billstar.plans import warehouse as W
from billstar.sources import files
from tests.conftest import write_text
from tests.test_ingest import HEADER, OPTS


def deliver(folder: str, first: int, n: int, facilities: int = 3, hot: bool = False) -> str:
    """Unpaid and paid invoices of a few facilities over three months; ``hot``: all of one patient."""
    os.makedirs(folder, exist_ok=True)
    rows = "\n".join(
        f"P{0 if hot else i},N,F,ETAB00{i % facilities},Clinique {i % facilities},URGENCES,{1 + i % 28:02d}/0{1 + i % 3}/2025,"
        f"{100 + 7 * i}.{i % 100:02d},{'PAYE' if i % 4 == 0 else 'IMPAYE'},{10 * i if i % 4 == 0 else 0},"
        f"{'28/04/2025' if i % 4 == 0 else ''},1" for i in range(first, first + n))
    write_text(os.path.join(folder, "etablissement1_x.csv"), f"{HEADER}\n{rows}\n")
    return folder


def load(spark, root, batch, **what):
    runner.run_batch(spark, files.manifest(spark, deliver(os.path.join(root, "..", batch), **what)), root, OPTS, batch)


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def same_as_full_scan(spark, root) -> bool:
    at = W.state(spark, root)
    dims, fact = runner.read_dims(spark, root, at), runner.read_fact(spark, root, at)
    stats, monthly = runner.totals_views(spark, root, at, dims)
    for made, full in ((stats, views.stats_etablissement(fact, dims)), (monthly, views.ca_mensuel(fact, dims))):
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in full.schema]
        assert "fact_facturation" not in "".join(made.inputFiles()) and made.count() > 0
        assert rows_of(made) == rows_of(full)
    return True


def test_totals_equal_the_full_scan_after_every_step(spark, workdir):
    root = os.path.join(workdir, "wh")
    load(spark, root, "b1", first=0, n=60)
    assert same_as_full_scan(spark, root)                     # no labels yet
    _, at = runner.score_and_publish(spark, root, OPTS)
    assert same_as_full_scan(spark, root)
    before = W.read_table(spark, root, "label_totals", at).agg(F.sum("anomalies")).first()[0]
    assert before == runner.read_fact(spark, root, at).where("anomaly_score = -1").count() > 0
    load(spark, root, "b2", first=40, n=50, facilities=5)     # overlaps b1, new facilities
    load(spark, root, "b3", first=0, n=20)                    # nothing new
    assert same_as_full_scan(spark, root)
    runner.score_and_publish(spark, root, OPTS)
    assert same_as_full_scan(spark, root)
    runner.register_views(spark, root, OPTS)
    assert "fact_facturation" not in "".join(spark.table("v_ca_mensuel").inputFiles())


def test_a_warehouse_from_before_the_totals_is_scanned(spark, workdir, monkeypatch):
    root = os.path.join(workdir, "wh")
    load(spark, root, "b1", first=0, n=30)
    real, at = W.state, W.state(spark, root)
    old = {t: p for t, p in at.parts.items() if t not in ("fact_keys", "fact_totals")}
    monkeypatch.setattr(W, "state", lambda *a: replace(real(*a), parts={
        t: p for t, p in real(*a).parts.items() if t in old or real(*a).number > at.number}))
    assert runner.totals_views(spark, root, W.state(spark, root), runner.read_dims(spark, root)) is None
    snapshot, buckets = runner.loaded_keys(spark, root, W.state(spark, root))
    assert buckets is None and snapshot.count() == 30
    runner.register_views(spark, root, OPTS)
    assert spark.table("v_ca_mensuel").agg(F.sum("nombre_factures")).first()[0] == 30


def test_loaded_keys_are_compared_without_an_exchange(spark, workdir):
    root = os.path.join(workdir, "wh")
    W.create(spark, root, buckets=5)
    load(spark, root, "b1", first=0, n=60)
    load(spark, root, "b2", first=30, n=60)
    at = W.state(spark, root)
    keys, buckets = runner.loaded_keys(spark, root, at)
    assert buckets == 5 and rows_of(keys) == rows_of(
        W.read_table(spark, root, "fact_facturation", at).select(keys.columns))
    candidates = spark.range(200).selectExpr(
        "id as patient_key", "20250101 + id % 5 as date_key", "cast(id as decimal(12,2)) as montant_facture")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = not_already_loaded(candidates, keys.where("mois_facturation = 202501"), buckets)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1, plan  # the candidates'
        assert new.count() == 200
        assert not_already_loaded(keys, keys, buckets).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_patient_lies_in_all_buckets(spark, workdir):
    root = os.path.join(workdir, "wh")
    load(spark, root, "b1", first=0, n=200, hot=True)
    keys = W.read_table(spark, root, "fact_keys")
    found = [r["count"] for r in keys.groupBy(F.input_file_name()).count().collect()]
    assert len(found) == 3 * W.DEFAULT_BUCKETS and max(found) < 3 * min(found) + 20
    load(spark, root, "b2", first=100, n=200, hot=True)
    fact = W.read_table(spark, root, "fact_facturation")
    assert fact.count() == fact.select(*FACT_DEDUP_KEYS).distinct().count() == 300


@pytest.mark.parametrize("table", ["fact_keys", "fact_totals"])
def test_a_batch_without_rows_keeps_its_tables_in_step(spark, workdir, table):
    root = os.path.join(workdir, "wh")
    load(spark, root, "b1", first=0, n=10)
    load(spark, root, "b2", first=0, n=10)
    at = W.state(spark, root)
    assert W.keeps(at, table) and len(at.parts[table]) == 2
    assert W.read_table(spark, root, "fact_facturation", at).count() == 10
