"""Partitioned Parquet sinks, declared-type gold tables and write audits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .partitions import hadoop_path


def write_partitioned(df: DataFrame, root: str, ingest_date: str,
                      observation: Observation | None = None) -> None:
    """Write ``df`` as the ``ingest_date`` partition of ``root``.

    Dynamic partition overwrite replaces only that date, so a rerun for the
    same date is idempotent and other dates are kept.
    """
    out = df.withColumn("ingest_date", F.lit(ingest_date).cast("date"))
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date").parquet(root))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project and cast ``df`` to a declared schema (missing columns → null)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, schema: StructType | None = None,
                observation: Observation | None = None) -> None:
    """Replace a gold table at ``path`` (optionally cast to ``schema``)."""
    out = conform(df, schema) if schema is not None else df
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, from the file system's own summary."""
    p, fs = hadoop_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def audited_writes(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                   ingest_date: str, sources: dict[str, str] | None = None) -> DataFrame:
    """Write each table as a dated partition and return the audit.

    Row counts are collected by an ``Observation`` during the write itself (no
    second pass); the audit is one row per table: table, path, rows, bytes and
    the source it came from.
    """
    rows = []
    for name, df in tables.items():
        obs = Observation(f"audit_{name}_{uuid.uuid4().hex[:6]}")
        path = f"{root.rstrip('/')}/{name}"
        write_partitioned(df, path, ingest_date, obs)
        size = folder_bytes(spark, f"{path}/ingest_date={ingest_date}")
        rows.append((name, path, int(obs.get["rows"]), size, (sources or {}).get(name)))
    return spark.createDataFrame(rows, "table_name string, path string, n_rows bigint, size_bytes bigint, source string")


def manifest(audit: DataFrame, run_id: str = "", ingest_date: str = "") -> DataFrame:
    """Manifest totals (one row): run, date, time, table count, rows and bytes.

    The per-table entries are the audit rows themselves, written beside it.
    """
    return audit.agg(
        F.count(F.lit(1)).alias("table_count"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"),
    ).select(F.lit(run_id).alias("run_id"), F.lit(ingest_date).alias("ingest_date"),
             F.current_timestamp().cast("string").alias("generated_at"), "*")


def write_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file so that readers see the old or the new text, never none.

    Written beside and renamed over it; object stores replace a key when its
    upload is complete, so there the file is written directly.
    """
    jvm = spark._jvm
    target, fs = hadoop_path(spark, path)
    renames = fs.getScheme() in ("file", "hdfs", "viewfs")
    written = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}") if renames else target
    out = fs.create(written, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if renames:
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        how = spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(written), fs.makeQualified(target), how)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               schema: StructType | None = None, batch_rows: int = 500) -> None:
    """Replace ``table`` in a JDBC database (the optional served-database form).

    Rows are sent in multi-row batches of ``batch_rows`` by every task in
    parallel.  Not exercised by the tests: no database server runs here.
    """
    out = conform(df, schema) if schema is not None else df
    props = {"batchsize": str(batch_rows), **(properties or {})}
    out.write.mode("overwrite").jdbc(url, table, properties=props)
