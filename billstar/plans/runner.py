"""The nightly batch as one Spark application (``run``) and its per-batch
core (``run_batch``), also used by the incremental stream.

Every step reads committed tables and writes new immutable files. A
batch's staging, dimension and fact parts become visible together, by one
commit at its end; a batch that fails leaves them as they were (its bronze and
silver folders, rejects and quarantine are its own work area). A batch
id already committed is skipped, so a replayed batch (stream retry, rerun)
is a no-op, and says so in its result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billstar.config import RunOptions
from billstar.operators import anomaly, marts, quality, totals, views
from billstar.operators import constraints as K
from billstar.operators.dimensions import Dims, new_dates, new_etablissements, new_patients, new_services
from billstar.operators.fact import FACT_DEDUP_KEYS, apply_scores, build_fact
from billstar.operators.loading import split_rejects, to_staging
from billstar.operators.standardize import read_and_standardize
from billstar.plans import warehouse as W
from billstar.plans.model import concurrently
from billstar.sources import files

def ensure_adaptive(spark: SparkSession) -> None:
    """Runtime re-planning the joins rely on: AQE, partition coalescing and
    skew-join splitting (a patient or facility holding a third of all rows
    is split across tasks instead of landing in one). Only switched on when
    the session has not set them explicitly."""
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled",
                "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, "true")


@dataclass
class BatchResult:
    batch_id: str
    skipped: bool
    silver_rows: int = 0
    rejected_rows: int = 0
    malformed_rows: int = 0
    staged_rows: int = 0
    inserted_facts: int = 0
    quarantined_facts: int = 0
    report: dict | None = None


DIMENSIONS = (("dim_patient", new_patients, "patient"), ("dim_etablissement", new_etablissements, "etablissement"),
              ("dim_date", new_dates, "date"), ("dim_service", new_services, "service"))


def billing_month(date_key: Column) -> Column:
    """yyyymmdd key -> yyyymm, the partition of the fact."""
    return F.floor(date_key / 100).cast("int").alias(W.MONTH.name)


def read_dims(spark: SparkSession, root: str, at: W.State | None = None, extra: dict | None = None) -> Dims | None:
    """The dimensions as committed, plus parts a batch has not committed
    yet (``extra``: table -> path). They carry no hint: the planner
    broadcasts one only under the session's threshold, by measured bytes."""
    at = at or W.state(spark, root)
    tables = [W.read_paths(spark, root, t, (*at.parts.get(t, ()), *([extra[t]] if extra else [])))
              for t, _, _ in DIMENSIONS]
    if tables[0] is None:
        return None
    patient, etablissement, date, service = tables
    return Dims(patient, etablissement, date, service)


def read_fact(spark: SparkSession, root: str, at: W.State | None = None,
              months: list[int] | None = None) -> DataFrame | None:
    """Fact rows with the current anomaly labels laid over them, of all or
    some billing months. Both are bucketed by fact_id, so the join
    exchanges no row of either."""
    at = at or W.state(spark, root)
    fact, labels = (W.read_table(spark, root, t, at) for t in ("fact_facturation", "anomaly_scores"))
    if fact is None:
        return None
    if months is not None:
        fact, labels = (t if t is None else t.where(F.col(W.MONTH.name).isin(months)) for t in (fact, labels))
    return apply_scores(fact, labels)


def loaded_keys(spark: SparkSession, root: str, at: W.State) -> tuple[DataFrame | None, int | None]:
    """The keys of the loaded invoices, and their number of buckets; of a
    warehouse that has no table of them the fact itself, in none of its keys' buckets."""
    if W.keeps(at, "fact_keys"):
        return W.read_table(spark, root, "fact_keys", at), W.buckets_of(spark, root)
    return W.read_table(spark, root, "fact_facturation", at), None


def run_batch(spark: SparkSession, paths: DataFrame, root: str, opts: RunOptions, batch_id: str) -> BatchResult:
    """Files of one batch (a manifest, or any DataFrame with ``path``) -> warehouse.

    If another writer commits in the meantime, staging, dimensions and fact
    are worked out again from the new state, up to ``opts.commit_attempts``
    times; bronze and silver are kept.
    """
    base = W.state(spark, root)
    if batch_id in base.batches:
        return BatchResult(batch_id, skipped=True)
    ensure_adaptive(spark)
    root = root.rstrip("/")
    ts = opts.timestamp
    ingest_date = opts.as_of.strftime("%Y%m%d")

    # bronze: verbatim copies of this batch's files, a folder for each layout
    copies = files.lay_out(paths, f"{root}/bronze/ingest_date={ingest_date}/batch={batch_id}")

    # silver: standardised, one partition per (ingest date, batch)
    silver_root = f"{root}/silver"
    rows, malformed = read_and_standardize(spark, copies, ts, opts.strict)
    W.write_silver(rows, silver_root, ingest_date, batch_id)
    silver = W.read_silver(spark, silver_root, ingest_date).where(F.col("run_id") == batch_id)
    n_malformed = 0
    if malformed is not None:
        obs = Observation(f"malformed_{batch_id}")
        malformed.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
            f"{root}/malformed/batch={batch_id}")
        n_malformed = int(obs.get["n"])

    # quality gate (one pass), then load filters
    report = quality.gate(quality.quality_report(silver, ts)).first().asDict()
    if opts.strict and report["critical"]:
        raise quality.QualityGateError(f"quality gate failed for batch {batch_id}: {report}")
    valid, rejects = split_rejects(silver)
    # the report already counts both reject reasons (they are disjoint: a
    # NULL billing date compares to nothing), so a clean batch needs no
    # extra scan of silver for its rejects
    rejected = int(report["missing_date_facturation"]) + int(report["incoherent_dates"])
    if rejected:
        rejects.write.mode("overwrite").parquet(f"{root}/rejects/batch={batch_id}")

    result = BatchResult(batch_id, False, silver_rows=int(report["total_rows"]), rejected_rows=rejected,
                         malformed_rows=n_malformed, report=report)
    for left in range(opts.commit_attempts - 1, -1, -1):
        try:
            return _load(spark, valid, paths, root, opts, base, result)
        except W.ConflictError:
            base = W.state(spark, root)
            if batch_id in base.batches:
                return BatchResult(batch_id, skipped=True)
            if not left:
                raise


def _load(spark: SparkSession, valid: DataFrame, paths: DataFrame, root: str, opts: RunOptions, base: W.State,
          result: BatchResult) -> BatchResult:
    """Staging, dimensions and fact of a batch on top of ``base``, and the commit."""
    batch_id, ts, attempt = result.batch_id, opts.timestamp, uuid4().hex[:8]

    # staging: ids continue after the largest committed id; written once,
    # read back, so later steps see fixed ids
    add = {"staging_facturation": W.new_path(root, "staging_facturation", batch_id)}
    staged = to_staging(valid).withColumn(
        "staging_id", F.lit(base.max_staging_id + 1) + F.monotonically_increasing_id())
    seen = Observation(f"staging_{batch_id}_{attempt}")
    W.write_part(staged.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("staging_id").alias("top")),
                 root, add["staging_facturation"])
    batch = W.read_paths(spark, root, "staging_facturation", [add["staging_facturation"]])

    # dimensions: new members only (insert if absent); independent jobs
    existing = read_dims(spark, root, base)
    add |= {table: W.new_path(root, table, batch_id) for table, _, _ in DIMENSIONS}
    concurrently([(W.write_part, (fn(batch, ts, getattr(existing, attr) if existing else None), root, add[table]))
                  for table, fn, attr in DIMENSIONS])
    dims = read_dims(spark, root, base, add)

    # fact: anti-join against the fact as it was before this insert, in the
    # batch's billing months only (the month is part of the compared key).
    # The fact's constraints (T8) are checked in the pass that writes the rows: only conforming rows are
    # written, the others are counted; strict mode then raises (like the
    # rejected INSERT) before the commit, lenient mode quarantines them.
    snapshot, buckets = loaded_keys(spark, root, base)
    if snapshot is not None:
        months = [r[0] for r in batch.select(F.expr("cast(date_format(date_facturation, 'yyyyMM') as int)")).distinct()
                  .collect()]
        snapshot = snapshot.where(F.col(W.MONTH.name).isin(months))
    rows = W.by_bucket(build_fact(batch, dims, ts, snapshot, buckets), root, "fact_facturation")
    checked = rows.withColumn("_broken", K.broken_rules(K.fact_rules()))
    fact_obs = Observation(f"fact_{batch_id}_{attempt}")
    observed = checked.observe(fact_obs, F.count(F.lit(1)).alias("rows"),
                               F.count_if(F.size("_broken") > 0).alias("broken"))
    add["fact_facturation"] = W.new_path(root, "fact_facturation", batch_id)
    W.write_part(observed.where(F.size("_broken") == 0).drop("_broken").select("*", billing_month(F.col("date_key"))),
                 root, add["fact_facturation"], "fact_facturation")
    broken = int(fact_obs.get["broken"])
    if broken and opts.strict:
        raise K.ConstraintError(f"batch {batch_id}: {broken} fact rows break the fact constraints "
                                f"(see {K.__name__}.fact_rules)")
    if broken:
        # rare path: the offending rows (with the rules they break) are kept
        (checked.where(F.size("_broken") > 0)
         .write.mode("overwrite").parquet(f"{root}/quarantine/fact_facturation/batch={batch_id}"))

    # what later batches and the totals views read instead of the fact
    inserted = W.read_part(spark, root, "fact_facturation", add["fact_facturation"])
    add |= {table: W.new_path(root, table, batch_id) for table in ("fact_keys", "fact_totals")}
    keys = inserted.select(*FACT_DEDUP_KEYS, W.MONTH.name).distinct()
    concurrently([(W.write_part, (W.by_bucket(keys, root, "fact_keys"), root, add["fact_keys"], "fact_keys")),
                  (W.write_part, (totals.fact_totals(inserted), root, add["fact_totals"]))])

    if "length" in paths.columns:
        add["loaded_files"] = W.write_part(paths.select(*FILE_KEY), root, W.new_path(root, "loaded_files", batch_id))
    top = seen.get["top"]
    W.commit(spark, root, base, batch=batch_id, add=add, max_staging_id=None if top is None else int(top))
    return replace(result, staged_rows=int(seen.get["rows"]), inserted_facts=int(fact_obs.get["rows"]) - broken,
                   quarantined_facts=broken)


FILE_KEY = ("path", "length", "modificationTime")


def new_files(spark: SparkSession, input_dir: str, root: str) -> DataFrame:
    """The manifest's files that no committed batch has loaded; a file that
    changed (length or time) counts as new."""
    found = files.manifest(spark, input_dir)
    loaded = W.read_table(spark, root, "loaded_files")
    return found if loaded is None else found.join(loaded.select(*FILE_KEY), list(FILE_KEY), "left_anti")


def delivery_id(delivery: DataFrame) -> str | None:
    """A batch id from the set of (path, length, time) of a delivery, the
    same on a rerun; None for an empty one."""
    row = delivery.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.xxhash64(*FILE_KEY).cast("decimal(38,0)")).alias("h")).first()
    return f"d{row.n}-{int(row.h) % (1 << 64):016x}" if row.n else None


def _digests(labels: DataFrame) -> DataFrame:
    """One row per month: a digest of its labels."""
    return labels.groupBy(W.MONTH.name).agg(F.sum(F.xxhash64(
        "fact_id", "anomaly_score", "anomaly_decision").cast("decimal(38,0)")).alias("digest"))


def score_and_publish(spark: SparkSession, root: str, opts: RunOptions, at: W.State | None = None):
    """Anomaly step: score the unpaid invoices of the whole fact as of
    ``at`` and lay the labels over older ones. Only the months whose labels
    differ from the current ones are written. (result, state after it);
    ConflictError if something was committed since ``at``."""
    at = at or W.state(spark, root)
    # features need no earlier labels: the raw parts, without the overlay join
    fact = W.read_table(spark, root, "fact_facturation", at)
    if fact is None:
        return None, at
    res = anomaly.score_anomalies(fact, opts.iforest_trees, opts.iforest_psi, opts.contamination, opts.seed,
                                  opts.min_rows_for_scoring)
    if res.scores is None:
        return res, at  # too few rows: earlier labels stay
    labels = res.scores.join(fact.select("fact_id", W.MONTH.name), "fact_id").select(W.SCHEMAS["anomaly_scores"].fieldNames())
    old = W.read_table(spark, root, "anomaly_scores", at)
    if old is not None:
        labels = old.join(res.scores.select("fact_id"), "fact_id", "left_anti").unionByName(labels)
    now = _digests(labels)
    if old is not None:
        before = _digests(old).withColumnRenamed("digest", "before")
        now = now.join(before, W.MONTH.name, "left").where("not digest <=> before")
    changed = [r[0] for r in now.select(W.MONTH.name).collect()]  # months
    if not changed:
        return res, at
    path = W.write_part(W.by_bucket(labels.where(F.col(W.MONTH.name).isin(changed)), root, "anomaly_scores"), root,
                        W.new_path(root, "anomaly_scores", f"v{at.number + 1}"), "anomaly_scores")
    return res, W.commit(spark, root, at, add={"anomaly_scores": path},
                         replace={"label_totals": _count_anomalies(spark, root, at, path, changed)})


def _count_anomalies(spark: SparkSession, root: str, at: W.State, path: str, changed: list[int]) -> str:
    """Write the anomalies by month and facility once the labels at ``path``
    count: new counts of the changed months, the others as they were."""
    after = replace(at, parts=at.parts | {"anomaly_scores": (*at.parts.get("anomaly_scores", ()), path)})
    old = W.read_table(spark, root, "label_totals", at)
    whole = old is None and "anomaly_scores" in at.parts  # labels from before this table
    now = totals.anomaly_totals(read_fact(spark, root, after, None if whole else changed))
    if old is not None:
        now = now.unionByName(old.where(~F.col(W.MONTH.name).isin(changed)))
    return W.write_part(now, root, W.new_path(root, "label_totals", f"v{at.number + 1}"))


def publish_mart(spark: SparkSession, root: str, opts: RunOptions, at: W.State | None = None) -> W.State:
    """Rebuild the collection mart from the state ``at`` as a new snapshot
    version; the state after it."""
    at = at or W.state(spark, root)
    mart = marts.relance(read_fact(spark, root, at), read_dims(spark, root, at), opts.as_of, opts.overdue_days,
                         opts.priority_amount, opts.important_days, sort=False)
    return W.publish(mart, spark, root, "relance", at)


def read_mart(spark: SparkSession, root: str, opts: RunOptions, at: W.State | None = None) -> DataFrame:
    """Stored order is not kept by files: the reader sorts."""
    from billstar.functions import bands
    mart = W.read_table(spark, root, "relance", at)
    return mart.orderBy(bands.priority_rank(F.col("anomaly_score"), F.col("montant_impaye"), opts.priority_amount),
                        F.col("montant_impaye").desc_nulls_first(), F.col("fact_id"))


def register_views(spark: SparkSession, root: str, opts: RunOptions, at: W.State | None = None) -> None:
    at = at or W.state(spark, root)
    dims = read_dims(spark, root, at)
    fact = read_fact(spark, root, at)
    stats, monthly = totals_views(spark, root, at, dims) or (
        views.stats_etablissement(fact, dims),
        # the monthly view uses no label: it skips the overlay join
        views.ca_mensuel(W.read_table(spark, root, "fact_facturation", at), dims))
    W.register_views(spark, {"v_facturation_complete": views.facturation_complete(fact, dims),
                             "v_stats_etablissement": stats, "v_ca_mensuel": monthly})


def totals_views(spark: SparkSession, root: str, at: W.State, dims: Dims) -> tuple[DataFrame, DataFrame] | None:
    """(facility statistics, monthly revenue) from the kept totals; None
    for a warehouse that has rows or labels from before they were kept."""
    if not W.keeps(at, "fact_totals") or ("anomaly_scores" in at.parts and "label_totals" not in at.parts):
        return None
    sums, anomalies = (W.read_table(spark, root, t, at) for t in ("fact_totals", "label_totals"))
    return totals.stats_etablissement(sums, anomalies, dims), totals.ca_mensuel(sums, dims)


def run(spark: SparkSession, input_dir: str, warehouse_dir: str, opts: RunOptions | None = None,
        batch_id: str | None = None) -> dict:
    """The whole nightly chain over the files of ``input_dir`` that are not
    loaded yet, as of today unless ``opts`` says otherwise. The summary
    tells a skipped batch and a delivery without new files."""
    opts = opts or RunOptions.today()
    delivery = new_files(spark, input_dir, warehouse_dir)
    batch_id = batch_id or delivery_id(delivery)
    res = run_batch(spark, delivery, warehouse_dir, opts, batch_id) if batch_id else None
    for left in range(opts.commit_attempts - 1, -1, -1):
        at = W.state(spark, warehouse_dir)
        if not at.parts.get("fact_facturation"):
            return {"batch": res, "skipped": True, "scored": None, "threshold": None, "mart_rows": 0}
        try:
            forest, at = score_and_publish(spark, warehouse_dir, opts, at)
            at = publish_mart(spark, warehouse_dir, opts, at)
            break
        except W.ConflictError:  # a batch came in between: label and publish what it left
            if not left:
                raise
    register_views(spark, warehouse_dir, opts, at)
    mart = read_mart(spark, warehouse_dir, opts, at)
    return {"batch": res, "skipped": res is None or res.skipped, "scored": None if forest is None else forest.n,
            "threshold": None if forest is None else forest.threshold, "mart_rows": mart.count()}
