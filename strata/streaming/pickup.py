"""Land only the raw files that arrived since the previous run.

A file-source stream over the raw folder remembers in its checkpoint which
files it has already processed; each ``availableNow`` run turns the new files
into one or more micro-batches and stops.  Each micro-batch is a listing of
paths and sizes (the ``binaryFile`` content column is never selected), which
is landed with the same distributed copy as the batch path; the upload records
are appended to ``<bronze>/_uploads`` partitioned by ingestion date.

Re-running after a failure is safe: a micro-batch that did not commit is
replayed, its copies overwrite the same keys and its upload records are
replaced by ``(ingest_date, batch)`` partition.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.bronze import copy_files, landing_plan, relative_paths

_BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def land_new_files(spark: SparkSession, raw_root: str, bronze_root: str, checkpoint: str,
                   ingest_date: str | None = None, glob: str = "*.csv",
                   max_files_per_batch: int = 1000) -> DataFrame:
    """Land raw files not seen by previous runs; returns this run's uploads."""
    day = ingest_date or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")
    uploads_root = f"{bronze_root.rstrip('/')}/_uploads"
    stream = (spark.readStream.format("binaryFile").schema(_BINARY_SCHEMA)
                   .option("pathGlobFilter", glob).option("recursiveFileLookup", True)
                   .option("maxFilesPerTrigger", max_files_per_batch)
                   .load(raw_root))
    batches: list[int] = []

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        files = relative_paths(batch.select("path", "length"), raw_root)
        uploads = copy_files(landing_plan(files, day), bronze_root)
        (uploads.withColumn("ingest_date", F.lit(day).cast("date"))
                .withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("ingest_date", "batch").parquet(uploads_root))
        batches.append(batch_id)

    query = (stream.writeStream.foreachBatch(land_batch)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())
    query.awaitTermination()
    if not batches:
        return spark.createDataFrame([], "key string, size_bytes bigint, source string")
    return (spark.read.parquet(uploads_root)
                 .where((F.col("ingest_date") == F.lit(day).cast("date")) & F.col("batch").isin(batches))
                 .select("key", "size_bytes", "source"))
