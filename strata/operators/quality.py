"""Primary- and foreign-key checks run before publication.

A table's own key and all its foreign keys are checked in one scan of it.  A
parent whose ids are whole numbers in a bounded range becomes bitmaps (a bit
an id, 32,768 ids a row), which are broadcast: the child is then not shuffled
for that key, and its rows only look up a bit.  Whether they fit is told by
the range of the ids before any is built.  Other parents are joined by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bitmaps of a parent (of 4 KiB each) that are broadcast, at most.
MAX_BITMAPS = 8_192
_IDS = 32_768


class ConstraintViolation(RuntimeError):
    pass


def pk_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Key values that repeat or contain a null, with their row counts."""
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .where((F.col("n_rows") > 1) | null_key))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    # An anti-join only asks whether a key exists, so the parent's keys need not be distinct.
    keys = parent.select(F.col(pk).alias("__pk"))
    return (child.where(F.col(fk).isNotNull())
                 .join(keys, F.col(fk) == F.col("__pk"), "left_anti"))


def id_bitmaps(parent: DataFrame, pk: str, max_bitmaps: int = MAX_BITMAPS) -> DataFrame | None:
    """The ids of ``parent`` as bitmaps (bucket, bits), or None if they are no whole numbers or may need more."""
    if not isinstance(parent.schema[pk].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return None
    key = F.col(f"`{pk}`").cast("long")
    low, high = parent.agg(F.min(key), F.max(key)).first()
    if low is not None and (high - low) // _IDS + 2 > max_bitmaps:
        return None
    return parent.where(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("__bucket")) \
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("__bits"))


def has_bit(bits: Column, key: Column) -> Column:
    """Whether the bitmap of the key's bucket holds the key."""
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substr(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def with_orphans(child: DataFrame, fks: list[tuple[str, DataFrame, str]], max_bitmaps: int = MAX_BITMAPS, made: dict | None = None) -> DataFrame:
    """``child`` with ``__orphan0``, ``__orphan1`` ...: whether each key of ``fks`` (column, parent, its key) lacks its parent.

    ``made`` keeps the bitmaps of parents that several tables point to.
    """
    made = {} if made is None else made
    for k, (fk, parent, pk) in enumerate(fks):
        if (id(parent), pk) not in made:
            made[id(parent), pk] = id_bitmaps(parent, pk, max_bitmaps)
        bitmaps = made[id(parent), pk]
        key = F.col(f"`{fk}`")
        if bitmaps is not None and isinstance(child.schema[fk].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            at = bitmaps.select(F.col("__bucket").alias("__at"), "__bits")
            child = child.join(F.broadcast(at), F.bitmap_bucket_number(key.cast("long")) == F.col("__at"), "left")
            found = has_bit(F.col("__bits"), key.cast("long"))
            child = child.withColumn(f"__orphan{k}", key.isNotNull() & ~found).drop("__at", "__bits")
        else:
            known = parent.select(F.col(f"`{pk}`").alias("__pk")).where("__pk is not null").distinct()
            child = child.join(known, key == F.col("__pk"), "left")
            child = child.withColumn(f"__orphan{k}", key.isNotNull() & F.col("__pk").isNull()).drop("__pk")
    return child


def table_report(df: DataFrame, pks: list[tuple[str, list[str]]], fks: list[tuple[str, str, DataFrame, str]],
                 max_bitmaps: int = MAX_BITMAPS, made: dict | None = None) -> DataFrame:
    """One row per constraint of a table, from one scan of it.

    A primary key counts its values that repeat or hold a null, a foreign key
    its rows without a parent.
    """
    columns = list(dict.fromkeys([*[c for _, cols in pks[:1] for c in cols], *[fk for _, fk, _, _ in fks]]))
    slim = df.select(*[F.col(f"`{c}`") for c in columns])
    flagged = with_orphans(slim, [(fk, parent, pk) for _, fk, parent, pk in fks], max_bitmaps, made)
    sums = [F.coalesce(F.sum(F.col(f"__orphan{k}").cast("long")), F.lit(0)).alias(f"__v{k}") for k in range(len(fks))]
    names = [(name, "foreign_key") for name, *_ in fks]
    if pks:
        name, cols = pks[0]
        null_key = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in cols])
        # The rows of a key value are added up map-side, orphans with them.
        flagged = flagged.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("__n"), *sums)
        sums = [F.coalesce(F.sum(f"__v{k}"), F.lit(0)).alias(f"__v{k}") for k in range(len(fks))]
        sums.append(F.coalesce(F.sum(((F.col("__n") > 1) | null_key).cast("long")), F.lit(0)).alias(f"__v{len(fks)}"))
        names.append((name, "primary_key"))
    rows = [F.struct(F.lit(n).alias("check_name"), F.lit(kind).alias("kind"), F.col(f"__v{k}").alias("violations")) for k, (n, kind) in enumerate(names)]
    return flagged.agg(*sums).select(F.inline(F.array(*rows)))


def constraint_report(pks: dict[str, tuple[DataFrame, list[str]]],
                      fks: dict[str, tuple[DataFrame, str, DataFrame, str]], max_bitmaps: int = MAX_BITMAPS) -> DataFrame:
    """One row per constraint: (check_name, kind, violations); constraints of one DataFrame share one scan of it."""
    tables: dict[int, tuple[DataFrame, list, list]] = {}
    for name, (df, cols) in pks.items():
        known = tables.setdefault(id(df), (df, [], []))
        if known[1]:
            # A second key of the same table is a grouping of its own.
            known = tables.setdefault((id(df), name), (df, [], []))
        known[1].append((name, cols))
    for name, (child, fk, parent, pk) in fks.items():
        tables.setdefault(id(child), (child, [], []))[2].append((name, fk, parent, pk))
    made: dict = {}
    return reduce(DataFrame.unionAll, [table_report(df, p, f, max_bitmaps, made) for df, p, f in tables.values()])


def assert_constraints(report: DataFrame) -> list:
    """Raise when any constraint is violated (all or nothing).

    The report has one row per constraint, so collecting it is bounded.
    """
    rows = report.collect()
    bad = [r for r in rows if r["violations"]]
    if bad:
        detail = ", ".join(f"{r['check_name']}={r['violations']}" for r in bad)
        raise ConstraintViolation(f"constraint check failed: {detail}")
    return rows
