"""Conformance queries of sources and sinks: files are formed from the driver tables, then read by the library's readers.

Raw files are written to the shared folder by Spark, landed, resolved and
read back as a run would do it; each oracle states the rows straight from the
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ConstraintViolation, constraint_report
from ..session import scratch_path
from ..sources import bronze
from ..sources.csv import NA_TOKENS
from ..sources.documents import flatten, malformed, read_documents
from ..sources.partitions import hadoop_path
from ..sources.publish import Publication
from ..sources.records import read_csv_files
from .conformance import query, table
from .medallion import RANKING_PREFIX, resolve_inputs

_TOKENS = ", ".join("'" + t + "'" for t in NA_TOKENS)


@query("csv_quoted_newlines", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(t) AS n_chars, md5(t) AS digest, CASE WHEN lang IN ({_TOKENS}) THEN NULL ELSE lang END AS lang
FROM (SELECT *, CASE WHEN text IN ({_TOKENS}) THEN NULL ELSE text END AS t FROM documents)
""")
def csv_quoted_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with commas, quotes and newlines through CSV files that are read in splits."""
    path = scratch_path(spark, "quoted_newlines")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs.write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                       emptyValue="", nullValue="").csv(path)
    back = read_csv_files(spark, path)
    return back.select("doc_id", F.char_length("text").alias("n_chars"), F.md5("text").alias("digest"), "lang")


#: Files of a snapshot.
SNAPSHOT_FILES = 16


@query("snapshot_files", f"""
SELECT CAST(c_custkey AS VARCHAR) AS team, CAST(c_custkey + CASE WHEN c_custkey % {SNAPSHOT_FILES} % 2 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) AS points,
       CASE WHEN c_custkey % {SNAPSHOT_FILES} % 2 = 0 THEN c_mktsegment END AS confederation,
       'fifa_ranking_' || CAST(c_custkey % {SNAPSHOT_FILES} AS VARCHAR) || '.csv' AS source_file
FROM customer
""")
def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest copy of each snapshot file, headers that differ, one scan."""
    root = scratch_path(spark, "snapshots")
    c = table(spark, sf_dir, "customer")
    file = (F.col("c_custkey") % SNAPSHOT_FILES).alias("file")
    name, points = F.col("c_custkey").cast("string").alias("team"), F.col("c_custkey")
    _snapshot(c.select(file, name, points.cast("string").alias("points")), f"{root}/{RANKING_PREFIX}/ingest_date=2026-01-01")
    later = c.where((F.col("c_custkey") % SNAPSHOT_FILES) % 2 == 0)
    _snapshot(later.select(file, F.col("c_mktsegment").alias("confederation"), (points + 1_000_000).cast("string").alias("points"), name),
              f"{root}/{RANKING_PREFIX}/ingest_date=2026-02-01")
    chosen = resolve_inputs(spark, root)["fifa_ranking"]
    return read_csv_files(spark, chosen).select("team", "points", "confederation", "source_file")


def _snapshot(rows: DataFrame, folder: str) -> None:
    """The rows as files fifa_ranking_<file>.csv under ``folder``, one a value of ``file``."""
    spark, made = rows.sparkSession, scratch_path(rows.sparkSession, "snapshot-parts")
    rows.repartition(SNAPSHOT_FILES, "file").write.option("header", True).partitionBy("file").csv(made)
    target, fs = hadoop_path(spark, folder)
    fs.mkdirs(target)
    for file in range(SNAPSHOT_FILES):
        parts, _ = hadoop_path(spark, f"{made}/file={file}")
        for part in fs.listStatus(parts) if fs.exists(parts) else []:
            if part.getPath().getName().endswith(".csv"):
                fs.rename(part.getPath(), hadoop_path(spark, f"{folder}/fifa_ranking_{file}.csv")[0])


@query("bronze_landing", """
WITH line AS (
  SELECT 'raw_orders' AS source, CAST(o_orderkey AS VARCHAR) || ';' || o_orderstatus || ';' || CAST(o_custkey AS VARCHAR) AS t FROM orders
  UNION ALL SELECT 'raw_customers', CAST(c_custkey AS VARCHAR) || ';' || c_mktsegment FROM customer
  UNION ALL SELECT 'raw_divers', n_name FROM nation
)
SELECT source, '2026-06-01' AS ingest_date, 'run-1' AS run_id, true AS manifest_complete, true AS checksums_hold, count(*) AS n_lines,
       CAST(sum(strlen(t) + 1) AS BIGINT) AS size_bytes, CAST(sum(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT)) AS BIGINT) AS line_sum
FROM line GROUP BY source
""")
def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files discovered, landed and listed; the bytes, checksums and lines that arrived, by source."""
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    joined = lambda *cols: F.concat_ws(";", *[F.col(c).cast("string") for c in cols]).alias("value")
    table(spark, sf_dir, "orders").select(joined("o_orderkey", "o_orderstatus", "o_custkey")).write.text(f"{raw}/orders")
    table(spark, sf_dir, "customer").select(joined("c_custkey", "c_mktsegment")).write.text(f"{raw}/customers")
    table(spark, sf_dir, "nation").select(joined("n_name")).write.text(f"{raw}/loose")
    _to_root(spark, f"{raw}/loose", raw)
    uploads = bronze.land(spark, raw, root, "2026-06-01", glob="*.txt")
    manifests = f"{root}/_manifests/ingest_date=2026-06-01"
    bronze.write_manifest(uploads, manifests, "run-1", "2026-06-01")

    told = spark.read.json(f"{manifests}/summary")
    listed = spark.read.json(f"{manifests}/objects")
    landed = bronze.checksums(spark, root, "*.txt").withColumnRenamed("md5", "found")
    held = listed.join(landed.withColumn("key", F.regexp_extract("path", r"/((raw_[^/]+)/ingest_date=.*)$", 1)), "key", "full")
    by_source = held.groupBy(F.split("key", "/")[0].alias("source")).agg(
        F.bool_and(F.coalesce(F.col("found") == F.col("md5"), F.lit(False))).alias("checksums_hold"), F.sum("size_bytes").alias("size_bytes"), F.count("md5").alias("objects"))
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root)
    lines = lines.withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), r"/(raw_[^/]+)/ingest_date=", 1)).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("long")).alias("line_sum"))
    total = by_source.agg(F.sum("objects").alias("all_objects"), F.sum("size_bytes").alias("all_bytes"))
    complete = told.crossJoin(F.broadcast(total)).select("run_id", "ingest_date", (
        (F.col("object_count") == F.col("all_objects")) & (F.col("total_size_bytes") == F.col("all_bytes")) & F.col("generated_at").isNotNull()).alias("manifest_complete"))
    return by_source.join(lines, "source").crossJoin(F.broadcast(complete)).select(
        "source", "ingest_date", "run_id", "manifest_complete", "checksums_hold", "n_lines", "size_bytes", "line_sum")


def _to_root(spark: SparkSession, folder: str, root: str) -> None:
    """The part files of ``folder`` as files right under ``root``."""
    path, fs = hadoop_path(spark, folder)
    for part in fs.listStatus(path):
        if part.getPath().getName().endswith(".txt"):
            fs.rename(part.getPath(), hadoop_path(spark, f"{root}/{part.getPath().getName()}")[0])


@query("publish_audit", """
WITH o AS (SELECT c_nationkey AS nation, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT 'first' AS version, 'orders.key=' || (SELECT CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderkey % 10 = 0) AS refused, 2 AS n_runs,
       nation, count(*) AS n_orders, CAST(sum(cents) AS BIGINT) AS cents FROM o GROUP BY nation
UNION ALL
SELECT 'current', 'orders.key=' || (SELECT CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderkey % 10 = 0), 2,
       nation, count(*), CAST(sum(cents + 1) AS BIGINT) FROM o GROUP BY nation
""")
def publish_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, one refused for repeated keys, one more; the first as of its time and the current one."""
    run = Publication(spark, scratch_path(spark, "publication"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))

    def keys(t: dict[str, DataFrame]) -> DataFrame:
        return constraint_report({"customers.key": (t["customers"], ["c_custkey"]), "orders.key": (t["orders"], ["o_orderkey"])},
                                 {"orders.customer": (t["orders"], "o_custkey", t["customers"], "c_custkey")})

    run.publish({"customers": customers, "orders": orders}, keys)
    first, refused = run.run_as_of()["published_at"], ""
    try:
        run.publish({"customers": customers, "orders": orders.union(orders.where("o_orderkey % 10 = 0"))}, keys)
    except ConstraintViolation as e:
        refused = str(e).rsplit(": ", 1)[1]
    run.publish({"customers": customers, "orders": orders.withColumn("cents", F.col("cents") + 1)}, keys)
    versions = []
    for version, as_of in (("first", first), ("current", None)):
        rows = run.read("orders", as_of).join(run.read("customers", as_of), F.col("o_custkey") == F.col("c_custkey"))
        versions.append(rows.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("cents"))
                        .select(F.lit(version).alias("version"), F.lit(refused).alias("refused"), F.lit(len(run.runs())).alias("n_runs"),
                                "nation", "n_orders", "cents"))
    return versions[0].unionByName(versions[1])


@query("nested_documents", """
SELECT 'item' AS kind, l_orderkey AS order_key, CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS qty, l_returnflag AS flag,
       nullif(concat_ws(',', CASE WHEN l_suppkey % 9 = 0 THEN 'note' END, CASE WHEN l_partkey % 20 = 0 THEN 'qty' END), '') AS rescued, count(*) AS n
FROM lineitem WHERE l_orderkey % 50 <> 0 GROUP BY ALL
UNION ALL SELECT 'malformed', NULL, NULL, NULL, NULL, count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey % 50 = 0
""")
def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested documents, some cut off, some with fields of another type or of no column."""
    path = scratch_path(spark, "documents")
    qty = F.when(F.col("l_partkey") % 20 == 0, F.lit('"many"')).otherwise(F.col("l_quantity").cast("long").cast("string"))
    note = F.when(F.col("l_suppkey") % 9 == 0, F.lit(',"note":{"by":[1,2]}')).otherwise(F.lit(""))
    item = F.concat(F.lit('{"qty":'), qty, F.lit(',"flag":"'), F.col("l_returnflag"), F.lit('"'), note, F.lit("}"))
    # An order has a few lines only.
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(item), ",").alias("lines"))
    text = F.concat(F.lit('{"order":'), F.col("l_orderkey").cast("string"), F.lit(',"lines":['), F.col("lines"),
                    F.when(F.col("l_orderkey") % 50 == 0, F.lit("")).otherwise(F.lit("]}")))
    orders.select(text.alias("value")).write.text(path)
    docs = read_documents(spark, path)
    items = flatten(docs, "$.lines", {"qty": "long", "flag": "string"}, {"order_key": ("$.order", "long")})
    names = F.array_join(F.array_sort(F.map_keys("rescued")), ",").alias("rescued")
    items = items.select(F.lit("item").alias("kind"), "order_key", "qty", "flag", names)
    items = items.groupBy(*items.columns).agg(F.count(F.lit(1)).alias("n"))
    return items.unionByName(malformed(docs).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("malformed")), allowMissingColumns=True)
