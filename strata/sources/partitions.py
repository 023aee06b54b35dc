"""Ingestion-date partitions: newest partition per table or per file name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_DATE_DIR = re.compile(r"^ingest_date=(\d{4}-\d{2}-\d{2})$")


class NoPartitionFound(FileNotFoundError):
    pass


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as Spark's own readers see them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def partition_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates of the ``ingest_date=`` folders right under ``root``; none if the path does not exist.

    One listing of one folder: its entries are dates, never data files.  Any
    error but a missing path is raised.
    """
    p, fs = hadoop_path(spark, root)
    if not fs.exists(p):
        return []
    return sorted(m[1] for s in fs.listStatus(p) if s.isDirectory() for m in [_DATE_DIR.match(s.getPath().getName())] if m)


def read_latest(spark: SparkSession, root: str, fmt: str = "parquet",
                as_of: str | None = None) -> DataFrame:
    """Rows of the newest ``ingest_date`` partition (optionally not after ``as_of``).

    Only that folder is read, so its own schema holds: columns may come, go or
    change type between dates.
    """
    dates = [d for d in partition_dates(spark, root) if not as_of or d <= as_of]
    if not dates:
        raise NoPartitionFound(f"no ingest_date partition under {root}")
    root = root.rstrip("/")
    return spark.read.format(fmt).option("basePath", root).load(f"{root}/ingest_date={dates[-1]}")
