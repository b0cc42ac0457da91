"""Persistent batch runner: a batch that fails before its commit marker
and is rerun leaves no duplicate silver, staging or fact rows; a new batch
continues the staging ids (A8, A10, J3, J4, failure handling)."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billstar.config import RunOptions
from billstar.plans import runner
from billstar.plans import warehouse as W
from billstar.sources import files
from billstar.operators import constraints as K
from tests.conftest import write_text
from tests.test_sources import make_inputs

# the inputs hold deliberately bad rows; the gate itself is tested elsewhere
OPTS = RunOptions(as_of=dt.date(2025, 6, 1), run_ts=dt.datetime(2025, 6, 1), strict=False)


def _paths(spark, d):
    return files.manifest(spark, d).select("path")


def test_rerun_after_failure_is_idempotent(spark, workdir, monkeypatch):
    inputs = os.path.join(workdir, "in")
    os.makedirs(inputs)
    make_inputs(inputs)
    root = os.path.join(workdir, "wh")

    # crash right before the commit: every table was written
    real = W.commit

    def crash(*args, **kw):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(W, "commit", crash)
    with pytest.raises(RuntimeError):
        runner.run_batch(spark, _paths(spark, inputs), root, OPTS, "b1")
    assert runner.read_fact(spark, root) is None and runner.read_dims(spark, root) is None
    assert W.read_staging(spark, root) is None
    monkeypatch.setattr(W, "commit", real)

    first = runner.run_batch(spark, _paths(spark, inputs), root, OPTS, "b1")
    assert not first.skipped
    staged = W.read_staging(spark, root)
    silver = W.read_silver(spark, f"{root}/silver")
    fact = runner.read_fact(spark, root)
    assert staged.count() == first.staged_rows
    assert silver.count() == first.silver_rows
    # one fact per conforming staging row, once; the row with a NULL amount
    # breaks the fact's NOT NULL (T8) and is quarantined by every load
    keyed = F.col("montant_facture").isNotNull()
    n_keyed = staged.where(keyed).count()
    n_null = staged.count() - n_keyed
    assert n_null == 1
    assert fact.count() == n_keyed
    assert first.inserted_facts == n_keyed                       # the crashed run left nothing visible
    assert first.quarantined_facts == n_null
    assert staged.select("staging_id").distinct().count() == staged.count()

    # the same files as a new batch: staging grows, ids continue, the fact does not
    second = runner.run_batch(spark, _paths(spark, inputs), root, OPTS, "b2")
    assert second.inserted_facts == 0 and second.quarantined_facts == n_null
    ids_b1 = [r[0] for r in W.read_staging(spark, root, "b1").select("staging_id").collect()]
    ids_b2 = [r[0] for r in W.read_staging(spark, root, "b2").select("staging_id").collect()]
    assert min(ids_b2) > max(ids_b1)
    assert W.max_staging_id(spark, root) == max(ids_b2)
    assert runner.read_fact(spark, root).count() == n_keyed

    # a committed batch id is skipped
    assert runner.run_batch(spark, _paths(spark, inputs), root, OPTS, "b2").skipped


PAID_MISSING = ("NumPatient,NomPatient,PrenomPatient,CodeEtablissement,NomEtablissement,ServiceMedical,"
                "DateFacture,Montant,StatutPaiement,MontantPaye,DatePaiement,NombreLignes\n"
                "A1,Dupont,Jean,ETAB001,Clinique ETAB001,URGENCES,05/01/2025,100.00,PAYE,100.00,25/01/2025,3\n"
                "A2,Martin,Anne,ETAB001,Clinique ETAB001,URGENCES,06/01/2025,200.00,IMPAYE,,,1\n")


def test_fact_constraints_strict_raises_lenient_quarantines(spark, workdir):
    """A NULL paid amount passes the gate and staging but breaks the fact's
    NOT NULL (T8): strict mode makes no fact row visible, lenient mode
    inserts the conforming rows and quarantines the other."""
    inputs = os.path.join(workdir, "in")
    os.makedirs(inputs)
    write_text(os.path.join(inputs, "etablissement1_facturation.csv"), PAID_MISSING)
    root = os.path.join(workdir, "wh")
    strict = RunOptions(as_of=OPTS.as_of, run_ts=OPTS.run_ts, strict=True)
    with pytest.raises(K.ConstraintError):
        runner.run_batch(spark, _paths(spark, inputs), root, strict, "b1")
    assert runner.read_fact(spark, root) is None                 # nothing committed
    res = runner.run_batch(spark, _paths(spark, inputs), root, OPTS, "b1")
    assert (res.inserted_facts, res.quarantined_facts) == (1, 1)
    assert [r.montant_facture for r in runner.read_fact(spark, root).collect()] == [Decimal("100.00")]
    q = spark.read.parquet(f"{root}/quarantine/fact_facturation/batch=b1").collect()
    assert len(q) == 1 and q[0].montant_paye is None and "not_null_montant_paye" in q[0]["_broken"]


def test_run_publishes_views_and_mart(spark, workdir):
    inputs = os.path.join(workdir, "in")
    os.makedirs(inputs)
    make_inputs(inputs)
    root = os.path.join(workdir, "wh")
    summary = runner.run(spark, inputs, root, OPTS, batch_id="d1")
    fact = runner.read_fact(spark, root)
    # the view registered over the unlabelled parts and the one over the
    # labelled fact agree on the totals
    monthly = spark.table("v_ca_mensuel").agg(F.sum("nombre_factures").alias("n")).first()["n"]
    stats = spark.table("v_stats_etablissement").agg(F.sum("nombre_factures").alias("n")).first()["n"]
    assert monthly == stats == fact.count()
    assert summary["mart_rows"] == runner.read_mart(spark, root, OPTS).count()
    assert summary["scored"] < OPTS.min_rows_for_scoring          # too few unpaid rows: scoring skipped


def test_rejects_written_with_reasons(spark, workdir):
    """Rejected rows (F1, F2) are data with a reason; their count is the
    report's two counters."""
    inputs = os.path.join(workdir, "in")
    os.makedirs(inputs)
    make_inputs(inputs)
    root = os.path.join(workdir, "wh")
    res = runner.run_batch(spark, _paths(spark, inputs), root, OPTS, "b1")
    rej = spark.read.parquet(f"{root}/rejects/batch=b1")
    assert rej.count() == res.rejected_rows == res.silver_rows - res.staged_rows > 0
    assert {r.reject_reason for r in rej.select("reject_reason").distinct().collect()} <= {
        "date_facturation_null", "date_paiement_avant_facturation"}
