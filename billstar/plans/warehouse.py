"""Persistent tables on any Hadoop-compatible file system.

* silver: Parquet partitioned by ``ingest_date`` / ``run_id`` (A8, A9);
  date partitions prune at scan time. A work area of its batch.
* staging, dimensions, fact: immutable parts, one per batch (A10).
* labels, mart: snapshots (A12).

What readers see of these tables is what the commit log names. A batch
writes its parts under paths of its own and then adds one numbered file
to ``<root>/_commits`` that lists them all. Adding it is the commit: all
tables of the batch become visible at once, a failed batch leaves nothing
visible, and of two writers that started from the same commit the second
fails. That last point needs a store whose rename fails on an existing
file (HDFS, local disks); ``commit`` refuses others. No directory is
renamed and no success marker is needed.

Fact and labels are stored by billing month and, within it, bucketed alike
by ``fact_id``: laying the labels over the fact exchanges nothing. A
scoring run adds the months whose labels changed; of each month the newest part counts.
``fact_keys`` holds the keys of loaded invoices, by month and bucketed by the
whole key, so a batch is compared with them without an exchange of theirs,
and a patient with a third of all rows is dealt over all buckets.
``fact_totals`` holds each batch's sums by month and facility, and
``label_totals`` the anomalies: what the two totals views add up.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstar.schema import (DIM_DATE, DIM_ETABLISSEMENT, DIM_PATIENT, DIM_SERVICE, FACT, SCORES, SILVER,
                             STAGING)
from billstar.operators.fact import FACT_DEDUP_KEYS
from billstar.operators.totals import ANOMALY_TOTALS, FACT_TOTALS, MONTH
from billstar.sources import fs

SCHEMAS = {
    "dim_patient": DIM_PATIENT,
    "dim_etablissement": DIM_ETABLISSEMENT,
    "dim_date": DIM_DATE,
    "dim_service": DIM_SERVICE,
    # stored by billing month, so that a batch reads only its months
    "fact_facturation": T.StructType(FACT.fields + [MONTH]),
    "anomaly_scores": T.StructType(SCORES.fields + [MONTH]),
    "staging_facturation": STAGING,
    "fact_keys": T.StructType([FACT[c] for c in FACT_DEDUP_KEYS] + [MONTH]),
    "fact_totals": FACT_TOTALS,
    "label_totals": ANOMALY_TOTALS,
}


#: Tables by month and bucket: the columns of their buckets.
BUCKETED = {"fact_facturation": ["fact_id"], "anomaly_scores": ["fact_id"], "fact_keys": FACT_DEDUP_KEYS}
#: Those of which a month's newest part replaces the older ones.
NEWEST_COUNTS = ("anomaly_scores",)
#: Buckets of a warehouse that was not created with a number of its own.
#: A month is joined by as many tasks: size it to the cluster.
DEFAULT_BUCKETS = 4
#: Partitions registered by one statement.
REGISTERED_AT_ONCE = 500


# ------------------------------------------------------------------- silver
def write_silver(df: DataFrame, root: str, ingest_date: str, run_id: str) -> str:
    out = root.rstrip("/")
    # dynamic overwrite replaces only this (ingest date, run) partition:
    # a rerun of the same batch rewrites its rows instead of adding them
    (df.withColumn("ingest_date", F.lit(ingest_date)).withColumn("run_id", F.lit(run_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_date", "run_id").parquet(out))
    return out


def read_silver(spark: SparkSession, root: str, ingest_date: str | None = None) -> DataFrame:
    schema = T.StructType(SILVER.fields + [T.StructField("ingest_date", T.StringType()),
                                           T.StructField("run_id", T.StringType())])
    df = spark.read.schema(schema).parquet(root.rstrip("/"))
    if ingest_date:
        df = df.where(F.col("ingest_date") == ingest_date)
    return df


# ---------------------------------------------------------------- commits
class ConflictError(RuntimeError):
    """Another writer committed first; rerun against the new state."""


@dataclass(frozen=True)
class State:
    """What a commit log says: the last commit's number, the batches, the
    parts of each table in order, and the largest staging id."""

    number: int = 0
    batches: tuple[str, ...] = ()
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)
    max_staging_id: int = 0


def _after(at: State, number: int, c: dict) -> State:
    """The state after a commit: it adds parts to tables, or replaces them."""
    batches, parts = ((), {}) if c.get("reset") else (at.batches, dict(at.parts))
    if c.get("batch"):
        batches = (*batches, c["batch"])
    for table, path in c.get("add", {}).items():
        parts[table] = (*parts.get(table, ()), path)
    for table, path in c.get("replace", {}).items():
        parts[table] = (path,)
    return State(number, batches, parts, max(at.max_staging_id, c.get("max_staging_id") or 0))


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def state(spark: SparkSession, root: str) -> State:
    """Replay the log. Take the state once and pass it on: what is read
    and what is committed then belong together."""
    at = State()
    for path in fs.list_files(spark, _commits(root), ".json"):
        at = _after(at, int(path.rsplit("/", 1)[-1].split(".")[0]), json.loads(fs.read_text(spark, path)))
    return at


#: Stores on which a rename fails if the target is there.
ATOMIC_RENAME = ("file", "hdfs", "viewfs")


def commit(spark: SparkSession, root: str, base: State, **entry) -> State:
    """Add the commit that follows ``base``; ConflictError if it is taken.
    The state it makes."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", root)
    if scheme and scheme[1].lower() not in ATOMIC_RENAME:
        raise ValueError(f"{scheme[1]}: URLs have no rename that fails on an existing file; "
                         f"keep the warehouse on one of {', '.join(ATOMIC_RENAME)}")
    fs.mkdirs(spark, _commits(root))
    path = f"{_commits(root)}/{base.number + 1:08d}.json"
    if not fs.create_once(spark, path, json.dumps(entry)):
        raise ConflictError(f"commit {base.number + 1} of {root} was made by another writer")
    return _after(base, base.number + 1, entry)


def create(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    """Create an empty warehouse (A14) of so many buckets a month; an
    existing one stays as it is."""
    fs.mkdirs(spark, _commits(root))
    if buckets:
        fs.create_once(spark, f"{root.rstrip('/')}/_buckets", str(buckets))


def buckets_of(spark: SparkSession, root: str) -> int:
    return int(fs.read_text(spark, f"{root.rstrip('/')}/_buckets") or DEFAULT_BUCKETS)


def reset(spark: SparkSession, root: str) -> None:
    """Empty all tables in one commit (A14: drop and create). Staging ids
    go on after the largest ever used, and files stay for older readers."""
    commit(spark, root, state(spark, root), reset=True)


def new_path(root: str, table: str, batch_id: str) -> str:
    """A path no other attempt writes to, relative to the root."""
    return f"{table}/batch={batch_id}/attempt={uuid.uuid4().hex[:12]}"


def _bucketed(spark: SparkSession, root: str, table: str, paths) -> DataFrame:
    """The parts as one table that knows its months and buckets. Only the
    months' folders of these parts are registered, so what no commit names stays unseen."""
    root, folders = root.rstrip("/"), {}
    for n, path in enumerate(paths):
        for folder in fs.list_dirs(spark, f"{root}/{path}"):
            month = folder.rsplit("=", 1)[-1]
            if folder.rsplit("/", 1)[-1].startswith(f"{MONTH.name}=") and month.isdigit():
                folders[month if table in NEWEST_COUNTS else (month, n)] = (n, month, folder)
    name = "billstar_" + sha1(json.dumps([root, table, sorted(folders.values())]).encode()).hexdigest()[:20]
    if not spark.catalog.tableExists(name):
        text, keys = "'{}'".format, ", ".join(BUCKETED[table])
        columns = T.StructType([f for f in SCHEMAS[table].fields if f.name != MONTH.name]).toDDL()
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} ({columns}, part INT, {MONTH.name} INT) USING parquet
            PARTITIONED BY (part, {MONTH.name}) CLUSTERED BY ({keys}) SORTED BY ({keys})
            INTO {buckets_of(spark, root)} BUCKETS LOCATION {text(f"{root}/{table}".replace("'", "\\'"))}""")
        found = [f"PARTITION (part={n}, {MONTH.name}={m}) LOCATION {text(folder.replace("'", "\\'"))}"
                 for n, m, folder in folders.values()]
        for i in range(0, len(found), REGISTERED_AT_ONCE):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(found[i:i + REGISTERED_AT_ONCE])}")
    return spark.table(name).select(SCHEMAS[table].fieldNames())


def read_paths(spark: SparkSession, root: str, table: str, paths) -> DataFrame | None:
    """The parts at ``paths`` (relative to the root) as one table."""
    if not paths:
        return None
    if table in BUCKETED:
        return _bucketed(spark, root, table, paths)
    schema = SCHEMAS.get(table)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    root = root.rstrip("/")
    df = reader.option("basePath", f"{root}/{table}").parquet(*[f"{root}/{p}" for p in paths])
    return df.select(schema.fieldNames()) if schema is not None else df.drop("batch", "attempt")


def read_table(spark: SparkSession, root: str, table: str, at: State | None = None) -> DataFrame | None:
    """The committed rows of a table, now or as of a state; None before
    its first commit."""
    at = at or state(spark, root)
    return read_paths(spark, root, table, at.parts.get(table))


def by_bucket(df: DataFrame, root: str, table: str) -> DataFrame:
    """Rows dealt so that each bucket of a month becomes one file."""
    return df.repartition(buckets_of(df.sparkSession, root), *BUCKETED[table])


def write_part(df: DataFrame, root: str, path: str, bucketed: str | None = None) -> str:
    """Write a part that no commit names yet; ``bucketed``: rows that
    :func:`by_bucket` dealt for that table, by billing month and bucket."""
    full = f"{root.rstrip('/')}/{path}"
    if not bucketed:
        df.write.parquet(full)
        return path
    spark, name = df.sparkSession, f"billstar_w_{uuid.uuid4().hex}"
    n, keys = buckets_of(spark, root), BUCKETED[bucketed]
    (df.write.format("parquet").partitionBy(MONTH.name).bucketBy(n, *keys).sortBy(*keys)
     .option("path", full).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return path


def read_part(spark: SparkSession, root: str, table: str, path: str) -> DataFrame:
    """One part as plain files, committed or not."""
    return spark.read.schema(SCHEMAS[table]).parquet(f"{root.rstrip('/')}/{path}")


def keeps(at: State, table: str) -> bool:
    """Whether each part of the fact has its part of ``table``; a warehouse
    begun before that table was there has not."""
    return len(at.parts.get(table, ())) == len(at.parts.get("fact_facturation", ()))


def read_staging(spark: SparkSession, root: str, batch_id: str | None = None) -> DataFrame | None:
    """Committed staging rows: one batch's, or all."""
    paths = state(spark, root).parts.get("staging_facturation", ())
    if batch_id is not None:
        paths = [p for p in paths if f"/batch={batch_id}/" in p]
    return read_paths(spark, root, "staging_facturation", paths)


def max_staging_id(spark: SparkSession, root: str) -> int:
    return state(spark, root).max_staging_id


def publish(df: DataFrame, spark: SparkSession, root: str, table: str, base: State) -> State:
    """Write a table's next snapshot, computed from the state ``base``, and
    make it the current one; ConflictError if something was committed since."""
    path = write_part(df, root, new_path(root, table, f"v{base.number + 1}"))
    return commit(spark, root, base, replace={table: path})


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Named temp views over the current tables."""
    for name, df in tables.items():
        if df is not None:
            df.createOrReplaceTempView(name)
