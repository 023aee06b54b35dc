"""Dense surrogate keys and sequential ranks from exact bucket counts.

``row_number() OVER (ORDER BY k)`` without ``PARTITION BY`` moves every row to
one task.  Here the rows are cut into buckets that follow the sort order and
hold at most ``part_rows`` rows each; a row's key is its bucket's offset, the
sum of the exact counts of all buckets before it, plus its number inside the
bucket.  Nothing is sampled, and the same plan serves every size: an input
that fits one bucket has one.

Buckets are found by refinement.  The sort key is read as a sequence of
numbers that follow its order (:class:`_Digits`: six bytes of a text at a time, the
halves of a long, a double as it is ...).  A round deals the rows of each
bucket that is still too large into equal-width cells over the digit in which
they differ, and counts them; the counts come with the digit's range in each
cell, and with those of the next digits, so that common prefixes are skipped.
A leading value that a third of all rows share is refined by the digits after
it.  The number of cells follows ``rows / part_rows``, so what the driver adds
up, and what is broadcast to tell each row its bucket, are bounded by the
number of buckets and never by the rows.

The input is computed once, into a reliable ``checkpoint()`` in the session's
shared ``spark.checkpoint.dir``.  All orderable columns and the checkpoint's
row numbers close the order, so the numbering is total and a task that runs
again numbers alike.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Rows of a bucket, and how many buckets are worth having: beyond, buckets grow.
PART_ROWS = 1_000_000
MAX_PARTS = 100_000
#: Digits whose ranges a round learns beside the one it cuts.
AHEAD = 3
#: Cells for each bucket that the counts call for, and at most for one refined bucket.
CELLS, MOST_CELLS = 4, 1 << 16
#: Rounds that follow each other in one plan: then the rows are stored with their buckets.
CHAIN = 4

_ROW, _BUCKET, _DIGIT = "__strata_row", "__strata_bucket", "__strata_digit"


@dataclass(frozen=True)
class descending:  # noqa: N801
    """A sort column in descending order (nulls last)."""
    name: str


def _sort_column(key) -> Column:
    if isinstance(key, descending):
        return F.col(f"`{key.name}`").desc_nulls_last()
    return F.col(f"`{key}`").asc_nulls_last()


class _Digits:
    """One sort column as a sequence of doubles that sort as it does.

    ``count`` digits; ``exact`` says that rows equal in all of them are equal
    in the column, so that what follows may decide.  A null column has null
    digits, NaN keeps its value.
    """

    def __init__(self, field: T.StructField, longest: int | None, down: bool):
        self.name, self.kind, self.down, self.exact = field.name, field.dataType, down, True
        if isinstance(self.kind, (T.StringType, T.BinaryType)):
            self.count = -(-(longest or 0) // 6) + 1
        elif isinstance(self.kind, (T.LongType, T.TimestampType, T.TimestampNTZType, T.FloatType, T.DoubleType)):
            self.count = 2
        else:
            self.count = 1
            self.exact = isinstance(self.kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.DateType))

    def value(self, depth: int) -> Column:
        c = F.col(f"`{self.name}`")
        if isinstance(self.kind, (T.StringType, T.BinaryType)):
            # Texts that differ in trailing zero bytes alone differ in length.
            if depth == self.count - 1:
                v = F.octet_length(c).cast("double")
            else:
                chunk = F.rpad(F.hex(F.substr(c.cast("binary"), F.lit(depth * 6 + 1), F.lit(6))), 12, "0")
                v = F.conv(chunk, 16, 10).cast("double")
        elif isinstance(self.kind, (T.FloatType, T.DoubleType)):
            # The magnitude first, so that the range of a bucket never overflows.
            c = c.cast("double")
            size = F.signum(c) * F.least(F.log2(1 + F.abs(c)), F.lit(2000.0))
            v = F.when(F.isnan(c), c).otherwise(size if depth == 0 else F.when(F.abs(c) < float("inf"), c).otherwise(F.lit(0.0)))
        elif isinstance(self.kind, (T.LongType, T.TimestampType)):
            c = F.unix_micros(c) if isinstance(self.kind, T.TimestampType) else c
            v = (F.shiftright(c, 32) if depth == 0 else c.bitwiseAND(F.lit(0xFFFFFFFF))).cast("double")
        elif isinstance(self.kind, T.TimestampNTZType):
            clock = (F.hour(c) * 3600 + F.minute(c) * 60).cast("double") * 1e6 + F.date_format(c, "s").cast("double") * 1e6 + F.date_format(c, "SSSSSS").cast("double")
            v = F.unix_date(F.to_date(c)).cast("double") if depth == 0 else clock
        elif isinstance(self.kind, T.DateType):
            v = F.unix_date(c).cast("double")
        elif isinstance(self.kind, T.BooleanType):
            v = c.cast("int").cast("double")
        elif isinstance(self.kind, T.NumericType):
            v = c.cast("double")
        else:
            v = F.when(c.isNotNull(), F.lit(0.0))
        if not self.down:
            return v
        return F.when(F.isnan(v), v).otherwise(-v) if isinstance(self.kind, (T.FloatType, T.DoubleType)) else -v


class _Sequence:
    """The digits of all sort columns, end to end."""

    def __init__(self, columns: list[_Digits]):
        self.columns, self.start = columns, [0]
        for c in columns:
            self.start.append(self.start[-1] + c.count)

    def column(self, digit: int) -> int:
        return max(k for k in range(len(self.columns)) if self.start[k] <= digit)

    def after(self, digit: int, whole_column: bool) -> int | None:
        """The digit that decides among rows equal in this one (null: in all of its column), if there is one."""
        k = self.column(digit)
        if not whole_column and digit + 1 < self.start[k + 1]:
            return digit + 1
        if k + 1 < len(self.columns) and (whole_column or self.columns[k].exact):
            return self.start[k + 1]
        return None

    def value(self, digit: int) -> Column:
        """A row's digit, null behind the last one."""
        if digit >= self.start[-1]:
            return F.lit(None).cast("double")
        k = self.column(digit)
        return self.columns[k].value(digit - self.start[k])

    def down(self, digit: int) -> bool:
        return self.columns[self.column(digit)].down


class _Node:
    """A bucket: how many rows, the digit to cut it by with its range, and its cells in order once it is cut."""

    def __init__(self, rows: int, digit: int | None, low: float, high: float):
        self.rows, self.digit, self.low, self.high = rows, digit, low, high
        self.number, self.cells, self.base, self.children = 0, 0, 0, {}

    def leaves(self):
        if not self.children:
            yield self
        for cell in sorted(self.children):
            yield from self.children[cell].leaves()


def _ranges(found: DataFrame, sequence: _Sequence, digits: list[int]) -> DataFrame:
    """For each new bucket, rows and the ranges of its digit (``__strata_v``) and the next ones; ``_DIGIT`` is its place in ``digits``."""
    wanted = sorted({d + k for d in digits for k in range(1, AHEAD + 1)})
    # Where the next digits of each digit begin; each is one element of an array, computed once a row.
    first = F.get(F.array(*[F.lit(wanted.index(d + 1)) for d in digits]), F.col(_DIGIT))
    found = found.select("__strata_new", "__strata_v", first.alias("__strata_first"), F.array(*[sequence.value(d) for d in wanted]).alias("__strata_next"))
    known = [F.col("__strata_v"), *[F.get("__strata_next", F.col("__strata_first") + k) for k in range(AHEAD)]]
    ahead = [F.nanvl(v, F.lit(None).cast("double")).alias(f"__strata_v{k}") for k, v in enumerate(known)]
    out = [F.count(F.lit(1)).alias("rows")]
    for k in range(AHEAD + 1):
        v = F.col(f"__strata_v{k}")
        out += [F.min(v).alias(f"low{k}"), F.max(v).alias(f"high{k}"), F.count(v).alias(f"known{k}")]
    return found.select("__strata_new", *ahead).groupBy("__strata_new").agg(*out)


def _told(spark: SparkSession, rows: list[tuple], **columns: str) -> DataFrame:
    """A broadcast table of a row a bucket, made in the driver (through Arrow: no Python worker takes part)."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    arrays = [pa.array(values, kinds[kind]) for values, kind in zip(zip(*rows, strict=True), columns.values(), strict=True)]
    return F.broadcast(spark.createDataFrame(pa.table(arrays, list(columns))))


def _settle(node: _Node, row, digit: int, sequence: _Sequence) -> None:
    """Skip the digits in which the bucket's rows do not differ."""
    node.digit, ahead = digit, 0
    while True:
        low, high, known = (row[f"{x}{ahead}"] for x in ("low", "high", "known"))
        node.low, node.high = low if low is not None else 0.0, high if high is not None else 0.0
        if known != node.rows or low != high:
            return
        after = sequence.after(node.digit, False)
        if after is None:
            node.digit = None
            return
        if after != digit + ahead + 1 or ahead == AHEAD:
            node.digit, node.low, node.high = after, None, None
            return
        node.digit, ahead = after, ahead + 1


def _buckets(rows: DataFrame, sequence: _Sequence, root: _Node, part_rows: int) -> tuple[DataFrame, list[_Node]]:
    """``rows`` with their bucket's number, and the buckets in order."""
    spark, number, open_, round_ = rows.sparkSession, 0, [root], 0
    rows = rows.withColumn(_BUCKET, F.lit(0).cast("long"))
    while open_ := [n for n in open_ if n.rows > part_rows and n.digit is not None]:
        round_ += 1
        if round_ % CHAIN == 0:
            rows = rows.checkpoint()
        cutting, plan = sorted({n.digit for n in open_}), []
        for n in open_:
            n.cells = 1 if n.low is None else min(MOST_CELLS, max(CELLS, -(-CELLS * n.rows // part_rows)))
            n.base, number = number + 1, number + n.cells + 3
            plan.append((n.number, cutting.index(n.digit), n.low or 0.0, ((n.high or 0.0) - (n.low or 0.0)) / n.cells, n.cells, n.base, sequence.down(n.digit)))
        cut = _told(spark, plan, **{_BUCKET: "long", _DIGIT: "int", "__strata_low": "double", "__strata_width": "double",
                                    "__strata_cells": "int", "__strata_base": "long", "__strata_down": "boolean"})
        own = rows.columns
        value = F.lit(None).cast("double")
        for k, d in enumerate(cutting):
            value = F.when(F.col(_DIGIT) == k, sequence.value(d)).otherwise(value)
        dealt = rows.join(cut, _BUCKET, "left").withColumn("__strata_v", value)
        v = F.col("__strata_v")
        inside = F.when(F.col("__strata_width") > 0, F.least(F.col("__strata_cells") - 1, F.floor((v - F.col("__strata_low")) / F.col("__strata_width")))).otherwise(0)
        # Cells in order: NaN of a descending column, values, NaN, nulls.
        cell = F.when(v.isNull(), F.col("__strata_cells") + 2).when(F.isnan(v), F.when(F.col("__strata_down"), 0).otherwise(F.col("__strata_cells") + 1)) \
                .otherwise(1 + F.greatest(F.lit(0).cast("long"), inside))
        new = F.when(F.col("__strata_base").isNotNull(), F.col("__strata_base") + cell).otherwise(F.col(_BUCKET)).cast("long")
        dealt = dealt.withColumn("__strata_new", new)
        counted = _ranges(dealt.where(F.col("__strata_base").isNotNull()), sequence, cutting).collect()
        rows = dealt.select(*[F.col(f"`{c}`") for c in own if c != _BUCKET], F.col("__strata_new").alias(_BUCKET))
        by_base = sorted(open_, key=lambda n: n.base)
        bases = [n.base for n in by_base]
        open_ = []
        for row in counted:
            parent = by_base[bisect_right(bases, row["__strata_new"]) - 1]
            child = _Node(row["rows"], None, 0.0, 0.0)
            child.number, at = row["__strata_new"], row["__strata_new"] - parent.base
            if at in (0, parent.cells + 1, parent.cells + 2):
                # All null or all NaN: the next column decides, its range is not known yet.
                child.digit, child.low, child.high = sequence.after(parent.digit, True), None, None
            else:
                _settle(child, row, parent.digit, sequence)
                if (child.rows, child.digit, child.low, child.high) == (parent.rows, parent.digit, parent.low, parent.high):
                    # A range too narrow for a double to divide.
                    child.digit = None
            parent.children[at] = child
            open_.append(child)
    return rows, list(root.leaves())


def dense_surrogate(df: DataFrame, order_by: list, id_col: str, first: bool = True, id_type: str = "bigint",
                    part_rows: int | None = None) -> DataFrame:
    """Add ``id_col`` = 1..n following ``order_by``.

    ``order_by`` takes column names (ascending) or :class:`descending`; nulls
    come last either way, the pandas default.  ``id_type="int"`` is for
    dimensions whose served schema says so; a number beyond it is an error.
    """
    ensure_checkpoint_dir(df.sparkSession)
    own = df.columns
    orderable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    named = {k.name if isinstance(k, descending) else k for k in order_by}
    keys = [*order_by, *[c for c in orderable if c not in named and c != id_col], _ROW]
    rows = df.withColumn(_ROW, F.monotonically_increasing_id()).checkpoint()
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    # The first digit's range comes with the counts; that of a text is its first bytes, however long it is.
    lead = keys[0]
    digit = _Digits(rows.schema[lead.name if isinstance(lead, descending) else lead], 1, isinstance(lead, descending)).value(0)
    shape = rows.withColumn("__strata_v", F.nanvl(digit, F.lit(None).cast("double"))).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(F.octet_length(f"`{c}`")).alias(f"len{k}") for k, c in enumerate(texts)],
        F.min("__strata_v").alias("low"), F.max("__strata_v").alias("high")).first()
    part_rows = part_rows or max(PART_ROWS, shape["n"] // MAX_PARTS)
    longest = {c: shape[f"len{k}"] for k, c in enumerate(texts)}
    digits = [_Digits(rows.schema[k.name if isinstance(k, descending) else k], longest.get(k.name if isinstance(k, descending) else k),
                      isinstance(k, descending)) for k in keys]
    order = [_sort_column(k) for k in keys]
    if shape["n"] <= part_rows:
        numbered = rows.withColumn(id_col, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast(id_type))
    else:
        root = _Node(shape["n"], 0, shape["low"], shape["high"])
        rows, leaves = _buckets(rows, _Sequence(digits), root, part_rows)
        numbered = _numbered(rows, leaves, order, id_col, id_type, part_rows)
    out = numbered.select(*[F.col(f"`{c}`") for c in own if c != id_col], id_col)
    return out.select(id_col, *[F.col(f"`{c}`") for c in own if c != id_col]) if first else out


def _numbered(rows: DataFrame, leaves: list[_Node], order: list[Column], id_col: str, id_type: str, part_rows: int) -> DataFrame:
    """Small neighbours share a group; each group is numbered on its own and starts where those before it end."""
    places, group, size, start, total = [], 0, 0, 0, 0
    for leaf in leaves:
        if size and size + leaf.rows > part_rows:
            group, size, start = group + 1, 0, total
        places.append((leaf.number, group, start))
        size, total = size + leaf.rows, total + leaf.rows
    spark = rows.sparkSession
    # A row for each bucket.
    known = _told(spark, places, **{_BUCKET: "long", "__strata_group": "long", "__strata_start": "long"})
    inside = F.row_number().over(Window.partitionBy("__strata_group").orderBy(*order))
    return rows.join(known, _BUCKET).withColumn(id_col, (F.col("__strata_start") + inside).cast(id_type))


def sequential_rank(df: DataFrame, measure: str, tie_break: list, rank_col: str, part_rows: int | None = None) -> DataFrame:
    """Row-number rank by ``measure`` descending; ties ordered by ``tie_break``."""
    return dense_surrogate(df, [descending(measure), *tie_break], rank_col, part_rows=part_rows)
