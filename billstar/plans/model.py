"""Warehouse over the driver tables, shared by the registered queries.

Silver is derived from the driver tables in one plan; silver, staging,
the dimensions and the fact are written once as Parquet tables in the
shared checkpoint folder (as the warehouse stores them) and every query
reads those tables. Operators are the same functions the persistent
runner uses.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.config import RunOptions
from billstar.operators.dimensions import Dims, build_dims
from billstar.operators.fact import build_fact
from billstar.operators.loading import split_rejects, to_staging
from billstar.session import scratch_dir
from billstar.sources.driver_tables import driver_silver

# Fixed value: the date the registered queries run as of, the day after
# the driver tables end.
DEFAULT_OPTIONS = RunOptions(as_of=dt.date(2001, 8, 2))

# Fixed value: the split date of the two-batch (incremental) scenario.
SECOND_BATCH_FROM = dt.date(1998, 7, 1)


@dataclass
class Model:
    silver: DataFrame
    valid: DataFrame
    rejects: DataFrame
    staging: DataFrame
    dims: Dims
    fact: DataFrame
    opts: RunOptions
    root: str | None = None


_MODELS: dict[tuple, Model] = {}


def written(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read back: cuts the
    lineage (a lost executor re-reads files instead of recomputing the
    joins) and gives later plans file statistics and column pruning."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concurrently(calls: list[tuple]) -> list:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each), so small outputs share the cluster instead of queueing; results
    in call order, the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, len(calls))) as pool:
        futures = [pool.submit(fn, *args) for fn, args in calls]
        return [f.result() for f in futures]


def from_driver_tables(spark: SparkSession, sf_dir: str, opts: RunOptions = DEFAULT_OPTIONS,
                       materialize: bool = True) -> Model:
    """Silver, staging, the dimensions and the fact are materialised
    tables, as in the warehouse. Built once per (application, table
    folder) and shared by queries."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), opts.as_of, opts.run_ts)
    if materialize and key in _MODELS:
        return _MODELS[key]
    ts = opts.timestamp
    silver = driver_silver(spark, sf_dir, ts)
    if materialize:
        root = scratch_dir(spark, "model")
        silver = written(silver, f"{root}/silver_facturation")
    valid, rejects = split_rejects(silver)
    staging = to_staging(valid)
    if materialize:
        staging = written(staging, f"{root}/staging_facturation")
    dims, _ = build_dims(staging, ts)
    if materialize:
        dims = Dims(*concurrently([(written, (d, f"{root}/{n}")) for n, d in (
            ("dim_patient", dims.patient), ("dim_etablissement", dims.etablissement),
            ("dim_date", dims.date), ("dim_service", dims.service))]))
    fact = build_fact(staging, dims, ts)
    if materialize:
        fact = written(fact, f"{root}/fact_facturation")
    model = Model(silver, valid, rejects, staging, dims, fact, opts, root if materialize else None)
    if materialize:
        _MODELS[key] = model
    return model


@dataclass
class TwoBatches:
    """Batch A = invoices billed before the split date; batch B = a full
    re-delivery of every invoice (so B overlaps A completely)."""

    dims_a: Dims
    fact_a: DataFrame
    dims_b: Dims
    new_dims_b: Dims
    new_fact_b: DataFrame


_BATCHES: dict[int, TwoBatches] = {}


def two_batches(m: Model) -> TwoBatches:
    """Batch A then batch B, each step written as the warehouse would
    write it (when the model is materialised); built once per model."""
    if id(m) in _BATCHES:
        return _BATCHES[id(m)]
    ts = m.opts.timestamp
    keep = (lambda df, name: written(df, f"{m.root}/two_batches/{name}")) if m.root else (lambda df, name: df)

    def keep_dims(d: Dims, tag: str) -> Dims:
        return Dims(*concurrently([(keep, (df, f"{name}_{tag}")) for name, df in (
            ("dim_patient", d.patient), ("dim_etablissement", d.etablissement),
            ("dim_date", d.date), ("dim_service", d.service))]))

    batch_a = m.staging.where(F.col("date_facturation") < F.lit(SECOND_BATCH_FROM))
    dims_a = keep_dims(build_dims(batch_a, ts)[0], "a")
    # batch A's fact and batch B's new members both depend on dims_a only:
    # written as concurrent jobs
    _, new_b = build_dims(m.staging, ts, existing=dims_a)
    fact_a, *new_b_parts = concurrently(
        [(keep, (build_fact(batch_a, dims_a, ts), "fact_a"))]
        + [(keep, (df, f"{name}_new_b")) for name, df in (
            ("dim_patient", new_b.patient), ("dim_etablissement", new_b.etablissement),
            ("dim_date", new_b.date), ("dim_service", new_b.service))])
    new_b = Dims(*new_b_parts)
    dims_b = Dims(dims_a.patient.unionByName(new_b.patient),
                  dims_a.etablissement.unionByName(new_b.etablissement),
                  dims_a.date.unionByName(new_b.date), dims_a.service.unionByName(new_b.service))
    # not written: reading it runs the anti-join against batch A's fact
    new_fact_b = build_fact(m.staging, dims_b, ts, fact_snapshot=fact_a)
    tb = TwoBatches(dims_a, fact_a, dims_b, new_b, new_fact_b)
    if m.root:
        _BATCHES[id(m)] = tb
    return tb
