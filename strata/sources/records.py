"""CSV records out of text splits: quoted newlines and differing headers without a task or a scan per file.

A reader that lets cells hold newlines must know whether a place lies inside
quotes, which depends on all quotes before it; so a whole file becomes one
task.  Here files are read as lines, split as Spark likes.  A line toggles
the state if it has an odd number of quotes.  Each split tells how many of
its lines do, and how many records would start in it for either state at its
beginning: one row a split.  A prefix over those rows gives the state and the
number of records at the beginning of every split, and so each line its
record.  Lines that are records of their own go on as they are; only those of
records that span lines are brought together.

Any number of files takes one scan: a file's header is its first record, and
a cell finds its column by the place that its name has in its own header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv import null_tokens

_LINE_SEPARATOR = "\n"


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def split_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file, split and number in it, and how many lines before it in the split toggle the state."""
    raw = spark.read.option("lineSep", _LINE_SEPARATOR).text(paths)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                       F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = lines.withColumn("odd", (_quotes(F.col("line")) % 2).cast("int"))
    # A task has one split at a time.
    inside = Window.partitionBy("file", "split").orderBy("at")
    before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.withColumn("toggles", before).withColumn("number", F.row_number().over(inside))


def split_states(lines: DataFrame) -> DataFrame:
    """For each split: whether it begins inside quotes, and the records that start before it in its file."""
    even = (F.col("toggles") % 2 == 0).cast("long")
    splits = lines.groupBy("file", "split").agg(F.sum("odd").alias("odd"), F.sum(even).alias("even"), F.sum(1 - even).alias("other"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("other"))
    return splits.withColumn("starts", starts).select("file", "split", "inside", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("records"))


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The records of CSV files: file, number (from 1 in each file) and record (its text, newlines included)."""
    lines = split_lines(spark, paths)
    known = lines.join(split_states(lines), ["file", "split"])
    begins = (F.col("toggles") + F.col("inside")) % 2 == 0
    begun = F.sum(begins.cast("long")).over(Window.partitionBy("file", "split").orderBy("at"))
    known = known.withColumn("begins", begins).withColumn("record_number", F.col("records") + begun)
    alone = F.col("begins") & (F.col("odd") == 0)
    whole = known.where(alone).select("file", F.col("record_number").alias("number"), F.col("line").alias("record"))
    # A record's own lines; two quoted newlines of one record are never more than its text.
    parts = known.where(~alone).groupBy("file", "record_number").agg(F.array_sort(F.collect_list(F.struct("split", "number", "line"))).alias("parts"))
    joined = parts.select("file", F.col("record_number").alias("number"), F.array_join(F.transform("parts", lambda p: p["line"]), _LINE_SEPARATOR).alias("record"))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def _cells(record: Column, width: int) -> Column:
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])
    return F.from_csv(record, schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"', "mode": "PERMISSIVE"})


def headers(records: DataFrame) -> DataFrame:
    """file and names (an array) of each file's header."""
    first = records.where("number = 1").select("file", "record").checkpoint()
    # No name holds more commas than the record has.
    width = (first.agg(F.max(F.length("record") - F.length(F.replace("record", F.lit(","), F.lit(""))))).first()[0] or 0) + 1
    cells = _cells(F.col("record"), width)
    bare = F.regexp_replace("record", '"[^"]*"', "")
    own = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return first.select("file", F.slice(F.array(*[cells[f"c{k}"] for k in range(width)]), F.lit(1), own).alias("names"))


def read_csv_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All files as one frame of strings, joined by column name, with ``source_file``.

    Cells may hold newlines; columns that a file lacks are null; missing-value
    tokens are null; blank lines are no rows.  A record with more cells than
    its header, or one whose quotes are never closed, is an error.
    """
    records = read_records(spark, paths)
    named = headers(records).checkpoint()
    # One short row a file; their distinct names are the columns, in order of appearance.
    seen = named.select("file", F.posexplode("names").alias("place", "name")).groupBy("name").agg(F.min(F.struct("place", "file")).alias("first"))
    columns = [r["name"] for r in seen.orderBy("first", "name").collect()]
    width = named.agg(F.max(F.size("names"))).first()[0] or 0
    if not columns:
        raise ValueError(f"no header under {paths}")
    places = F.array(*[F.array_position("names", c).cast("int") for c in columns])
    known = named.select("file", places.alias("places"), F.size("names").alias("width"))
    body = records.where("number > 1").where(F.trim("record") != "").join(known, "file")
    # One cell more than the widest header shows a record that has too many.
    cells = _cells(F.col("record"), width + 1)
    torn = (_quotes(F.col("record")) % 2 == 1) | F.coalesce(F.get(F.col("cells"), F.col("width")).isNotNull(), F.lit(False))
    body = body.withColumn("cells", F.array(*[cells[f"c{k}"] for k in range(width + 1)]))
    body = body.where(F.when(torn, F.raise_error(F.concat(F.lit("record with too many cells or an open quote: "), F.col("record"))).cast("boolean")).otherwise(True))
    out = [F.when(F.col("places")[k] > 0, F.get(F.col("cells"), F.col("places")[k] - 1)).alias(c) for k, c in enumerate(columns)]
    frame = null_tokens(body.select(*out, F.element_at(F.split("file", "/"), -1).alias("__source")))
    return frame.withColumnRenamed("__source", "source_file")
