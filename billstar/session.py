"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(
    master: str | None = None,
    app_name: str = "billstar",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session. On a cluster, build the session with the
    cluster's own settings; the library only reads them."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a local session, whose executors share
    the driver's disk, may do without: a temporary one is made there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="billstar-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, tag: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{tag}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster on which it is not
    installed: the functions that run in tasks import it there."""
    import shutil

    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="billstar-ship-"), "billstar")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root)))
