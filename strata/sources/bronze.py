"""Bronze: discover raw files and land them unchanged by ingestion date."""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, local_path

# Fixed value: prefix for files found directly under the raw root.
LOOSE_FILE_PREFIX = "raw_divers"


class NoRawFiles(FileNotFoundError):
    pass


def discover(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Raw files under ``root`` (recursive): path, relative path, size.

    ``binaryFile`` with only ``path`` and ``length`` selected lists files
    without reading their content.  An empty result is an error.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                  .option("pathGlobFilter", glob).load(root)
                  .select("path", "length"))
    out = relative_paths(files, root)
    if out.limit(1).count() == 0:
        raise NoRawFiles(f"no {glob} file under {root}")
    return out


def relative_paths(files: DataFrame, root: str) -> DataFrame:
    """(path, length) listing → path, path relative to ``root``, size_bytes."""
    base = local_path(root) or root.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^(file:)?/*" + re.escape(base.lstrip("/")) + "/?", "")
    return files.select("path", rel.alias("relpath"), F.col("length").alias("size_bytes"))


def landing_plan(files: DataFrame, ingest_date: str) -> DataFrame:
    """Route ``a/b.csv`` → ``raw_a/ingest_date=D/b.csv``; loose files → raw_divers."""
    parts = F.split("relpath", "/")
    nested = F.size(parts) > 1
    prefix = F.when(nested, F.concat(F.lit("raw_"), F.element_at(parts, 1))).otherwise(
        F.lit(LOOSE_FILE_PREFIX))
    name = F.when(nested, F.array_join(F.slice(parts, 2, F.size(parts) - 1), "/")).otherwise(
        F.col("relpath"))
    key = F.concat_ws("/", prefix, F.lit(f"ingest_date={ingest_date}"), name)
    return files.select("path", key.alias("key"), "size_bytes",
                        F.concat(F.lit("repo:"), F.col("relpath")).alias("source"))


def store_uri(uri: str) -> str:
    """Spark's names of the S3 connector as the one that pyarrow knows."""
    scheme, sep, rest = uri.partition("://")
    return f"s3://{rest}" if sep and scheme in ("s3a", "s3n") else uri


def _copy_partition(dest_root: str):
    def run(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        for pdf in batches:
            done = []
            for src, key in zip(pdf["path"], pdf["key"]):
                src_local = local_path(src)
                dst = f"{dest_root.rstrip('/')}/{key}"
                dst_local = local_path(dst)
                if src_local is not None:
                    sfs, spath = pafs.LocalFileSystem(), src_local
                else:
                    sfs, spath = pafs.FileSystem.from_uri(store_uri(src))
                if dst_local is not None:
                    dfs, dpath = pafs.LocalFileSystem(), dst_local
                else:
                    dfs, dpath = pafs.FileSystem.from_uri(store_uri(dst))
                dfs.create_dir(dpath.rsplit("/", 1)[0], recursive=True)
                # Streamed copy: the file never sits whole in a Spark row.  It goes to a name of
                # its own first, so a failed or doubled task leaves no torn file under the key.
                part = f"{dpath}.{uuid.uuid4().hex}.part"
                digest = hashlib.md5(usedforsecurity=False)
                with sfs.open_input_stream(spath) as fin, dfs.open_output_stream(part) as fout:
                    while True:
                        chunk = fin.read(8 << 20)
                        if not chunk:
                            break
                        fout.write(chunk)
                        digest.update(chunk)
                dfs.move(part, dpath)
                done.append((key, digest.hexdigest()))
            yield pd.DataFrame(done, columns=["key", "md5"])
    return run


def land(spark: SparkSession, raw_root: str, bronze_root: str, ingest_date: str,
         glob: str = "*.csv") -> DataFrame:
    """Copy every raw file byte for byte to its bronze key; return the uploads.

    Files are spread over tasks (one row per file, no file content in rows);
    a rerun for the same date overwrites the same keys.  The result lists key,
    size_bytes, source and md5 per file.
    """
    return copy_files(landing_plan(discover(spark, raw_root, glob), ingest_date), bronze_root)


def copy_files(plan: DataFrame, bronze_root: str) -> DataFrame:
    """Run the copies of a landing plan; returns (key, size_bytes, source, md5 of the bytes copied).

    Eager and reliable: the copy job runs exactly once here, and the upload
    list survives executor loss without re-running the copies.
    """
    spark = plan.sparkSession
    n = max(1, min(plan.count(), spark.sparkContext.defaultParallelism))
    copied = plan.repartition(n).select("path", "key").mapInPandas(
        _copy_partition(bronze_root), "key string, md5 string")
    ensure_checkpoint_dir(spark)
    return plan.join(copied, "key").select("key", "size_bytes", "source", "md5").checkpoint(eager=True)


def upload_manifest(uploads: DataFrame, run_id: str = "", ingest_date: str = "") -> DataFrame:
    """Ingestion manifest summary: run, date, time, object count and total bytes (one row).

    The object list grows with the number of files, so it is not folded into
    this row; it is the ``uploads`` dataset itself, written next to it.
    """
    return uploads.agg(
        F.count(F.lit(1)).alias("object_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"),
    ).select(F.lit(run_id).alias("run_id"), F.lit(ingest_date).alias("ingest_date"),
             F.current_timestamp().cast("string").alias("generated_at"), "*")


def write_manifest(uploads: DataFrame, folder: str, run_id: str, ingest_date: str) -> None:
    """The manifest of a landing: its summary and its objects, as JSON under ``folder``."""
    upload_manifest(uploads, run_id, ingest_date).coalesce(1).write.mode("overwrite").json(f"{folder}/summary")
    uploads.write.mode("overwrite").json(f"{folder}/objects")


def checksums(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """path and md5 of the landed files, streamed in the tasks, to hold against a manifest."""
    def run(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                local = local_path(path)
                fs, where = (pafs.LocalFileSystem(), local) if local is not None else pafs.FileSystem.from_uri(store_uri(path))
                digest = hashlib.md5(usedforsecurity=False)
                with fs.open_input_stream(where) as stream:
                    while chunk := stream.read(8 << 20):
                        digest.update(chunk)
                out.append((path, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["path", "md5"])

    files = discover(spark, root, glob).select("path")
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(run, "path string, md5 string")


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """A nested JSON document (object or array) as a typed DataFrame."""
    return spark.read.option("multiLine", True).json(path)


# Country records of a ``[paging, [countries…]]`` payload (public API shape).
COUNTRY_SCHEMA = ("array<struct<id:string,iso2Code:string,name:string,"
                  "region:struct<id:string,iso2code:string,value:string>,"
                  "incomeLevel:struct<id:string,iso2code:string,value:string>,"
                  "capitalCity:string,longitude:string,latitude:string>>")


def read_country_payload(spark: SparkSession, path: str, schema: str = COUNTRY_SCHEMA) -> DataFrame:
    """``[paging, [countries…]]`` payload files → one row per country.

    The second element of each document is parsed with ``from_json``; a
    payload without countries is an error (shape validation).
    """
    txt = spark.read.text(path, wholetext=True)
    items = txt.select(F.get_json_object("value", "$[1]").alias("js"))
    rows = (items.where(F.col("js").isNotNull())
                 .select(F.explode(F.from_json("js", schema)).alias("c")).select("c.*"))
    if rows.limit(1).count() == 0:
        raise ValueError("empty or unexpected country payload")
    return rows
