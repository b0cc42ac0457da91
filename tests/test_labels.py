"""Labels as a delta by month, the overlay without an exchange, and
writers that come in between."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from billstar.operators import anomaly
from billstar.plans import runner
from billstar.plans import warehouse as W
from billstar.sources import files
from tests.conftest import write_text
from tests.test_ingest import HEADER, OPTS


def deliver(folder: str, name: str, first: int, n: int) -> str:
    os.makedirs(folder, exist_ok=True)
    rows = "\n".join(f"P{i},N,F,ETAB001,Clinique,URGENCES,{1 + i % 28:02d}/0{1 + i % 3}/2025,{100 + 7 * i},IMPAYE,0,,1"
                     for i in range(first, first + n))
    write_text(os.path.join(folder, f"etablissement1_{name}.csv"), f"{HEADER}\n{rows}\n")
    return folder


@pytest.fixture()
def loaded(spark, workdir):
    root = os.path.join(workdir, "wh")
    inputs = deliver(os.path.join(workdir, "in"), "a", 0, 60)
    runner.run_batch(spark, files.manifest(spark, inputs), root, OPTS, "b1")
    return root


def months_of(root: str, part: str) -> list[str]:
    return sorted(d for d in os.listdir(os.path.join(root, part)) if d.startswith(W.MONTH.name))


def test_the_overlay_exchanges_nothing(spark, loaded):
    runner.score_and_publish(spark, loaded, OPTS)
    runner.run_batch(spark, files.manifest(spark, deliver(os.path.join(loaded, "..", "more"), "b", 60, 9)), loaded, OPTS, "b2")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = runner.read_fact(spark, loaded)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        one = runner.read_fact(spark, loaded, months=[202501])
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert fact.count() == 69 and fact.where("anomaly_score is not null").count() == 60
        assert one.where("mois_facturation <> 202501").count() == 0 and one.count() == 23
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_months_whose_labels_changed_are_written(spark, loaded, monkeypatch):
    fact = W.read_table(spark, loaded, "fact_facturation")
    bad = {"id": -1}

    def scores(*_):
        rows = fact.selectExpr("fact_id", f"if(fact_id = {bad['id']}, -1, 1) as anomaly_score", "0.5D as anomaly_decision")
        return SimpleNamespace(scores=rows, n=60, threshold=0.0)

    monkeypatch.setattr(anomaly, "score_anomalies", scores)
    _, first = runner.score_and_publish(spark, loaded, OPTS)
    assert len(months_of(loaded, first.parts["anomaly_scores"][-1])) == 3
    _, again = runner.score_and_publish(spark, loaded, OPTS)
    assert again == first
    bad["id"] = fact.where("mois_facturation = 202502").first().fact_id
    _, second = runner.score_and_publish(spark, loaded, OPTS)
    assert months_of(loaded, second.parts["anomaly_scores"][-1]) == [f"{W.MONTH.name}=202502"]
    labels = W.read_table(spark, loaded, "anomaly_scores")
    assert labels.count() == 60 and [r.fact_id for r in labels.where("anomaly_score = -1").collect()] == [bad["id"]]


@pytest.mark.parametrize("step", ["labels", "mart"])
def test_a_batch_between_reading_and_publishing_is_a_conflict(spark, loaded, monkeypatch, step):
    real, came = W.write_part, []

    def write(*args, **kw):
        if not came:
            came.append(1)
            W.commit(spark, loaded, W.state(spark, loaded), batch="between", add={})
        return real(*args, **kw)

    if step == "mart":
        runner.score_and_publish(spark, loaded, OPTS)
    before = W.state(spark, loaded)
    monkeypatch.setattr(W, "write_part", write)
    with pytest.raises(W.ConflictError):
        (runner.score_and_publish if step == "labels" else runner.publish_mart)(spark, loaded, OPTS)
    after = W.state(spark, loaded)
    assert after.batches == (*before.batches, "between") and after.parts == before.parts


def test_a_nightly_run_during_a_batch_loses_and_doubles_nothing(spark, workdir, loaded, monkeypatch):
    """Both load rows of one patient; the later commit sees the earlier one."""
    other = deliver(os.path.join(workdir, "other"), "o", 50, 20)
    mine = deliver(os.path.join(workdir, "mine"), "m", 55, 25)
    real, came = W.commit, []

    def commit(spark_, root, base, **entry):
        if entry.get("batch") == "b3" and not came:
            came.append(1)
            runner.run(spark, other, loaded, OPTS, "b2")
        return real(spark_, root, base, **entry)

    monkeypatch.setattr(W, "commit", commit)
    copies = []
    lay_out = files.lay_out
    monkeypatch.setattr(files, "lay_out", lambda *a: copies.append(1) or lay_out(*a))
    result = runner.run_batch(spark, files.manifest(spark, mine), loaded, OPTS, "b3")
    assert len(copies) == 2  # the raw copy of each batch, made once
    assert (result.staged_rows, result.inserted_facts) == (25, 10)
    at = W.state(spark, loaded)
    assert at.batches == ("b1", "b2", "b3")
    fact = W.read_table(spark, loaded, "fact_facturation", at)
    assert fact.count() == 80 and fact.select("fact_id").distinct().count() == 80
    patients = W.read_table(spark, loaded, "dim_patient", at)
    assert patients.count() == patients.select("patient_id_naturel").distinct().count() == 80


def test_the_last_attempt_raises(spark, workdir, loaded, monkeypatch):
    def commit(*_, **__):
        raise W.ConflictError("always")

    monkeypatch.setattr(W, "commit", commit)
    with pytest.raises(W.ConflictError):
        runner.run_batch(spark, files.manifest(spark, deliver(os.path.join(workdir, "x"), "x", 90, 5)), loaded, OPTS, "b9")


def test_stores_without_a_safe_rename_are_refused(spark):
    with pytest.raises(ValueError, match="s3a"):
        W.commit(spark, "s3a://bucket/wh", W.State(), batch="b", add={})
