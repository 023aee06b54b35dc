r"""Exact deduplication against a persistent digest index.

Texts are equal if they are identical once each run of white space
(``[\x20\x09-\x0D]+``) is one space; their identity is the SHA-256 of that
form.  A :class:`DigestIndex` keeps every digest seen so far with the id of
the row that stays, as a table bucketed and sorted by digest.  New data is
reduced to one row per digest, a sort-merge anti-join against the index
leaves the digests that are new, and those are appended.  The index side of
the joins is never shuffled, whatever it holds.

Texts are read once, for their digests; all else works on digests and ids.
A text that a third of all rows share is counted map-side.  To tell each row
its group, groups of more than ``max(100, rows / 10,000)`` rows are
broadcast: by that size there are at most 10,000 of them, whatever the data.
All other groups are joined by sort and merge, and none of them is large.

An append adds a digest once: after a lost driver the same batch may be
ingested again, digests that had come in are found there with the same id and
the others follow.  Batches are ingested one after the other.

Defined cases: a null text counts as empty, and empty texts are equal like
any others; texts of any length count whole; of rows equal in id and text one
stays; a null id loses against any other and stays only where the whole group
has none; an empty table adds nothing and resolves to no rows; columns named
like a result are replaced (:func:`new_documents` returns the columns it got).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.partitions import hadoop_path

#: Digests that one bucket of a new index should hold, about, and the fewest buckets.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 16
#: Groups too large for one task are broadcast: at most this many, by their size.
HEAVY_GROUPS = 10_000
HEAVY_ROWS = 100

ID, DIGEST, ROW = "__id", "__digest", "__row"
RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """Each run of white space as one space; single spaces are left as they are."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all but the text, unless given) with each row's id, digest and number.  Checkpointed."""
    ensure_checkpoint_dir(docs.sparkSession)
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return docs.select(*[F.col(f"`{c}`") for c in carry if c not in RESULTS], F.col(f"`{id_col}`").cast("long").alias(ID),
                       F.unhex(F.sha2(normalised(F.col(f"`{text}`")), 256)).alias(DIGEST),
                       F.monotonically_increasing_id().alias(ROW)).checkpoint()


def _place() -> Column:
    """Id and row number as one number, which is aggregated in place; null ids come last."""
    last = F.lit(str(1 << 63)).cast("decimal(38,0)")
    return (F.coalesce(F.col(ID).cast("decimal(38,0)"), last) * F.lit(1 << 60).cast("decimal(19,0)")).cast("decimal(38,0)") + F.col(ROW)


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the smallest id, the first row that has it, and the number of rows."""
    return rows.withColumn("__place", _place().cast("decimal(38,0)")).groupBy(DIGEST).agg(
        F.min(ID).alias("least"), F.min("__place").alias("first"), F.count(F.lit(1)).alias("n"))


class DigestIndex:
    """The digests seen so far (digest, keep_id), in buckets sorted by digest under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """Open the index at ``path``, or make an empty one there of ``buckets`` buckets."""
        self.spark, self.path = spark, path.rstrip("/")
        layout, fs = hadoop_path(spark, f"{self.path}/layout")
        if fs.exists(layout):
            self.buckets = spark.read.parquet(f"{self.path}/layout").first()["buckets"]
        else:
            self.buckets = buckets or LEAST_BUCKETS
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).coalesce(1).write.parquet(f"{self.path}/layout")
        # The name belongs to the path, so a second session that opens the path gets the same table.
        self.table = "strata_digests_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        place = f"{self.path}/digests".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` (from :func:`digest_rows`) that the index lacks, each with its smallest id."""
        groups = _groups(rows).select(F.col(DIGEST).alias("digest"), F.col("least").alias("keep_id"))
        fresh = groups.join(self.entries().hint("merge"), "digest", "left_anti")
        # Dealt as the buckets are, a task has the rows of one bucket and writes one file.
        fresh.repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def resolve(self, rows: DataFrame) -> DataFrame:
        """``rows`` with keep_id (the id that stays), group_size (equal rows among these), kept and text_sha256."""
        entry = self.entries().hint("merge").select(F.col("digest").alias(DIGEST), "keep_id")
        groups = _groups(rows).join(entry, DIGEST).select(
            DIGEST, "keep_id", F.col("n").alias("group_size"), F.when(F.col("least").eqNullSafe(F.col("keep_id")), F.col("first")).alias("first")).checkpoint()
        total = groups.agg(F.sum("group_size")).first()[0] or 0
        least = max(HEAVY_ROWS, total // HEAVY_GROUPS)
        heavy = F.broadcast(groups.where(F.col("group_size") > least))
        rest = rows.join(heavy.select(DIGEST), DIGEST, "left_anti").join(groups.where(F.col("group_size") <= least), DIGEST)
        both = rows.join(heavy, DIGEST).unionByName(rest)
        first = _place().cast("decimal(38,0)") == F.col("first")
        return both.select(*[F.col(f"`{c}`") for c in rows.columns if c not in (ID, DIGEST, ROW)], "keep_id", "group_size",
                           F.coalesce(first, F.lit(False)).alias("kept"), F.lower(F.hex(DIGEST)).alias("text_sha256"))


def new_documents(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the index had not seen, one of each group of equal ones; the index learns them.

    A row counts as seen if the index holds its text under another id.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(f"`{id_col}`").alias("__by"), F.col(f"`{text}`").alias("__of"))
    rows = digest_rows(named, "__by", "__of", ["__doc"])
    index.ingest(rows)
    return index.resolve(rows).where("kept").select("__doc.*")


def op13_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the row that stays of each group of equal texts.

    The lower half of the ids comes first, the rest as new data; the index
    is then asked for all.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = digest_rows(docs, carry=["doc_id"])
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(ID), F.max(ID)).first()
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), max(LEAST_BUCKETS, n // BUCKET_ROWS))
    stock = F.coalesce(F.col(ID) <= F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    index.ingest(rows.where(stock))
    index.ingest(rows.where(~stock))
    return index.resolve(rows)


OP13_SQL = r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS LAST) = 1 AS kept, h AS text_sha256
FROM t
"""
