"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  They are applied only when the
# caller builds the session through ``get_spark``; an existing cluster session
# keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.ui.enabled": "false",
    # Dense keys and landings checkpoint reliably; remove those files once
    # the DataFrames that use them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Wide projections of the table jobs fuse into generated methods above
    # HotSpot's 8 KB JIT limit; without this they run interpreted (2-3x slower).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def compile_small(spark: SparkSession) -> None:
    """Let Spark split generated methods that HotSpot would not compile (8,000 bytes), unless the session says otherwise.

    For sessions built elsewhere, whose JVMs lack ``-XX:-DontCompileHugeMethods``:
    the wide parsing projections would run interpreted there.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    flagged = all("-DontCompileHugeMethods" in (spark.conf.get(f"spark.{jvm}.extraJavaOptions", "") or "") for jvm in ("driver", "executor"))
    if not flagged and spark.conf.get(limit) == "65535":
        spark.conf.set(limit, "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is.  Only when nothing is configured and the master is local (unit
    tests on one machine) a private folder is created; executors of a cluster
    could not share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for intermediate tables.

    Scratch tables written by jobs (published layers, partitioned samples) go
    next to the checkpoints so that every executor of a cluster can read them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Local file-system path for ``file:`` URIs and plain paths, else None."""
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" in path:
        return None
    return os.path.abspath(path)
