"""CSV scans: all-string reads, null tokens, multi-level headers."""

from __future__ import annotations

import csv as _csv
import io
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import snake_name
from ..functions.numeric import to_double, to_long

# Cell texts that pandas' CSV reader turns into missing values.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")


def null_tokens(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """Turn exact missing-value tokens into null in every string column."""
    toks = F.array(*[F.lit(t) for t in tokens])
    cols = []
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string":
            cols.append(F.when(~F.coalesce(F.array_contains(toks, F.col(f.name)), F.lit(False)),
                               F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


_CORRUPT = "__corrupt"


def _checked(df: DataFrame, width: int) -> DataFrame:
    """Raise on rows that the reader would cut or tear: too many cells, or a quote left open.

    Rows with too few cells are complete but short; their last columns are null.
    """
    rec = F.col(_CORRUPT)
    quotes = F.length(rec) - F.length(F.replace(rec, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(rec, '"[^"]*"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    bad = F.coalesce((quotes % 2 == 1) | (cells > width), F.lit(False))
    # The first column is named too: a scan of the raw record alone is not allowed.
    message = F.concat(F.lit("row with too many cells or an open quote (quoted newlines need multiline=True): "), rec,
                       F.lit("; first cell: "), F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit("")))
    return df.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(_CORRUPT)


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])


def read_raw_csv(spark: SparkSession, path, multiline: bool = False,
                 with_source: bool = False) -> DataFrame:
    """Header CSV as all-string columns with missing-value tokens as null.

    No type inference (each job coerces its own columns).  ``multiline`` allows
    quoted newlines but makes each file a single task, so it is off by default
    (:func:`strata.sources.records.read_csv_files` reads such files in splits);
    a row torn by one, or with more cells than the header, is an error.
    ``with_source`` adds ``source_file`` (file name) from the scan metadata.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("mode", "PERMISSIVE")
    names = reader.csv(path).columns
    df = reader.schema(_strings(names)).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return null_tokens(_checked(df, len(names)))


def _header_lines(spark: SparkSession, path: str, n: int) -> list[list[str]]:
    # The first n physical lines of the first file (n is the header depth).
    lines = [r.value for r in spark.read.text(path).limit(n).collect()]
    return [next(_csv.reader(io.StringIO(line))) for line in lines]


def multiheader_names(header_rows: list[list[str]], n_index: int) -> list[str]:
    """Column names from two header levels plus an index-name row.

    Index columns take their names from the last row; other columns join their
    non-empty levels with ``_`` (pandas labels empty cells ``Unnamed…``, which
    are dropped) and are snake_cased.
    """
    levels, index_row = header_rows[:-1], header_rows[-1]
    width = max(len(r) for r in header_rows)
    names = []
    for i in range(width):
        if i < n_index:
            names.append(snake_name(index_row[i] if i < len(index_row) else ""))
            continue
        parts = [r[i] for r in levels if i < len(r) and r[i] != "" and not r[i].startswith("Unnamed")]
        names.append(snake_name("_".join(parts)) if parts else "col")
    return names


# Statistics columns that hold text; all others are numbers.
STATISTICS_TEXT = ("league", "team", "player", "nation", "pos", "age", "url")


def read_multiheader_csv(spark: SparkSession, path: str, n_index: int,
                         header_depth: int = 3, text: tuple[str, ...] | None = STATISTICS_TEXT) -> DataFrame:
    """Flatten a CSV with two header levels and an index-name row.

    The header lines (three per file) are read on the driver from the first
    file only; every file's header lines are then removed by content, so the
    read stays splittable and position-free.  Columns named in ``text`` are strings,
    ``season`` BIGINT and all others DOUBLE, so a table has the same types on
    every date.  ``text=None`` infers them instead with one aggregation pass
    (:func:`infer_types`).  A row with more cells than the header is an error.
    """
    header_rows = _header_lines(spark, path, header_depth)
    names = multiheader_names(header_rows, n_index)
    cells = [f"c{i}" for i in range(len(names))]
    raw = (spark.read.option("header", False).option("escape", '"').option("columnNameOfCorruptRecord", _CORRUPT)
                .option("recursiveFileLookup", True).schema(_strings(cells)).csv(path))
    raw = _checked(raw, len(names)).toDF(*names)
    is_header = None
    for row in header_rows:
        cells = [(row[i] if i < len(row) and row[i] != "" else None) for i in range(len(names))]
        cond = reduce(lambda a, b: a & b,
                      [F.col(n).eqNullSafe(F.lit(v).cast("string")) for n, v in zip(names, cells)])
        is_header = cond if is_header is None else (is_header | cond)
    data = null_tokens(raw.where(~is_header))
    if text is None:
        return infer_types(data)
    typed = lambda c: to_long(c).alias(c) if c == "season" else to_double(c).alias(c)
    return data.select(*[F.col(c) if c in text else typed(c) for c in names])


def infer_types(df: DataFrame) -> DataFrame:
    """Cast string columns to BIGINT or DOUBLE when every non-null value fits."""
    cand = df.columns
    if not cand:
        return df
    probes = []
    for c in cand:
        v = F.col(c)
        probes.append(F.bool_and(v.isNull() | v.try_cast("bigint").isNotNull()).alias(f"{c}__l"))
        probes.append(F.bool_and(v.isNull() | v.try_cast("double").isNotNull()).alias(f"{c}__d"))
    # One row of flags per column: bounded by the column count.
    flags = df.agg(*probes).first().asDict()
    out = []
    for c in df.columns:
        if c in cand and flags.get(f"{c}__l"):
            out.append(F.col(c).try_cast("bigint").alias(c))
        elif c in cand and flags.get(f"{c}__d"):
            out.append(F.col(c).try_cast("double").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def write_multiheader_csv(df: DataFrame, path: str, groups: list[tuple[str, str]],
                          index_names: list[str], n_files: int | None = None) -> None:
    """Write ``df`` as CSV files in the two-level-header layout, cells quoted where they need it.

    ``groups`` gives (level-0, level-1) labels of the non-index columns.  Each
    output file starts with the three header lines: rows are hash-spread over
    ``n_files`` file buckets (by default as many as shuffle partitions), the
    header lines are repeated in each bucket and sorted first inside it.
    """
    def line(cells):
        buf = io.StringIO()
        _csv.writer(buf, lineterminator="").writerow(cells)
        return buf.getvalue()

    blank = [""] * len(index_names)
    headers = [line(blank + [g for g, _ in groups]),
               line(blank + [s for _, s in groups]),
               line(index_names + [""] * len(groups))]
    spark = df.sparkSession
    n_files = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = F.struct(*[F.col(c).cast("string") for c in df.columns])
    body = df.select(F.to_csv(cells, {"escape": '"', "nullValue": "", "emptyValue": ""}).alias("value"))
    body = body.select("value", F.lit(len(headers)).alias("__ord"),
                       F.pmod(F.hash("value"), F.lit(n_files)).alias("bucket"))
    head = spark.createDataFrame([(h, i, b) for b in range(n_files) for i, h in enumerate(headers)],
                                 "value string, __ord int, bucket int")
    (head.unionByName(body).repartition(n_files, "bucket")
         .sortWithinPartitions("bucket", "__ord")
         .drop("__ord").write.mode("overwrite").partitionBy("bucket").text(path))

