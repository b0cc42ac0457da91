"""Registered queries that run the persistent batch and the incremental
stream end to end on files derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstar.operators import views
from billstar.operators.dimensions import Dims
from billstar.plans import runner
from billstar.plans.catalog import present, query
from billstar.plans.catalog_sources import fixture_dir
from billstar.session import scratch_dir
from billstar.sources import fs
from billstar.streaming.incremental import run_available


def natural_fact(fact: DataFrame, dims: Dims) -> DataFrame:
    """Fact rows by natural values (ids are free in the warehouse)."""
    return views.star(fact, dims).select(
        F.col("p.patient_id_naturel").alias("patient_id_naturel"),
        F.col("e.nom_etablissement").alias("nom_etablissement"),
        F.col("d.date_complete").alias("date_facturation"),
        F.col("s.service_nom").alias("service_nom"),
        F.col("f.montant_facture").alias("montant_facture"),
        F.col("f.montant_paye").alias("montant_paye"),
        F.col("f.montant_impaye").alias("montant_impaye"),
        F.col("f.delai_paiement_jours").alias("delai_paiement_jours"),
        F.col("f.nombre_lignes").alias("nombre_lignes"),
        F.col("f.statut_paiement").alias("statut_paiement"))


@query("run_batch_warehouse")
def q_run_batch_warehouse(spark, sf):
    """Files -> bronze -> silver -> gate -> staging -> dims -> fact, then
    the monthly view read from the committed warehouse tables."""
    d, m = fixture_dir(spark, sf)
    root = scratch_dir(spark, "warehouse")
    runner.run_batch(spark, runner.files.manifest(spark, d).select("path"), root, m.opts, "b1")
    return present(views.ca_mensuel(runner.read_fact(spark, root), runner.read_dims(spark, root)))


@query("run_batch_replay")
def q_run_batch_replay(spark, sf):
    """Same files loaded twice in two batches: staging doubles, the fact
    does not (second insert suppressed by the anti-join)."""
    d, m = fixture_dir(spark, sf)
    root = scratch_dir(spark, "warehouse")
    paths = runner.files.manifest(spark, d).select("path")
    runner.run_batch(spark, paths, root, m.opts, "b1")
    r2 = runner.run_batch(spark, paths, root, m.opts, "b2")
    r3 = runner.run_batch(spark, paths, root, m.opts, "b2")  # replayed batch id: skipped
    staging = runner.W.read_staging(spark, root)
    fact = runner.read_fact(spark, root)
    return spark.createDataFrame(
        [(staging.count(), fact.count(), r2.inserted_facts, r3.skipped)],
        "staging_rows long, fact_rows long, second_insert long, replay_skipped boolean")


@query("run_nightly")
def q_run_nightly(spark, sf):
    """The whole nightly chain: files, warehouse, labels, mart and views;
    what is returned is read back from the registered view."""
    d, m = fixture_dir(spark, sf)
    root = scratch_dir(spark, "warehouse")
    summary = runner.run(spark, d, root, m.opts)
    if summary["skipped"] or not summary["scored"]:
        raise RuntimeError(f"the nightly run did not load and score: {summary}")
    return present(spark.table("v_ca_mensuel"))


@query("run_nightly_mart")
def q_run_nightly_mart(spark, sf):
    """The persistent mart after a run, without the columns that the
    forest decides."""
    d, m = fixture_dir(spark, sf)
    root = scratch_dir(spark, "warehouse")
    runner.run(spark, d, root, m.opts)
    return present(runner.read_mart(spark, root, m.opts).select(
        "patient_nom", "nom_etablissement", "service_nom", "montant_impaye", "delai_jours", "date_facturation"))


@query("stream_incremental")
def q_stream_incremental(spark, sf):
    """Two drops into a watched folder, one availableNow run after each:
    each run picks up only the new files."""
    d, m = fixture_dir(spark, sf, shared=False)
    drop = scratch_dir(spark, "drop")
    fs.mkdirs(spark, drop)
    root = scratch_dir(spark, "warehouse")
    ckpt = scratch_dir(spark, "stream-ckpt")
    produced = fs.list_files(spark, d)
    first = [p for p in produced if p.rsplit("/", 1)[-1][:14] in ("etablissement1", "etablissement2",
                                                                    "etablissement3")]
    for p in first:
        fs.rename(spark, p, f"{drop}/{p.rsplit('/', 1)[-1]}")
    run_available(spark, drop, root, ckpt, m.opts)
    for p in produced:
        if p not in first:
            fs.rename(spark, p, f"{drop}/{p.rsplit('/', 1)[-1]}")
    run_available(spark, drop, root, ckpt, m.opts)
    return present(natural_fact(runner.read_fact(spark, root), runner.read_dims(spark, root)))
