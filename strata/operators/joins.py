"""Lookup joins with a checked broadcast side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest lookup side broadcast to every executor, in rows and in bytes.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


# Decisions already taken in this application, keyed by the plan's semantic
# hash and its input files: a rewritten table has new file names, so it is
# checked again.
_DECISIONS: dict[tuple, bool] = {}


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``MAX_BROADCAST_BYTES`` of values (reads at most max_rows+1)."""
    files = tuple(sorted(df.inputFiles()))
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), files, max_rows)
    if not files or key not in _DECISIONS:
        width = reduce(lambda a, b: a + b, [
            F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + F.lit(16) if f.dataType.simpleString() in ("string", "binary")
            else F.lit(16) for f in df.schema.fields], F.lit(16))
        n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
        decision = n <= max_rows and size <= MAX_BROADCAST_BYTES
        if not files:
            return decision
        _DECISIONS[key] = decision
    return _DECISIONS[key]


def lookup_side(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, check: str = "count") -> DataFrame:
    """The lookup side of a join, broadcast only behind a size check.

    ``check="count"``: ``broadcast(dim)`` when a bounded count proves at most
    ``max_rows`` rows, else a shuffled side; for scans and materialised
    dimensions, where the count stops early.  ``check="adaptive"``: no hint;
    for sides that are aggregates over large inputs, where a count would cost
    a full extra pass.  AQE then measures the materialised shuffle output and
    switches to a broadcast join only when it is below its threshold.
    """
    if check == "adaptive":
        return dim
    return F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                max_rows: int = MAX_BROADCAST_ROWS, check: str = "count") -> DataFrame:
    return fact.join(lookup_side(dim, max_rows, check), on, how)


def role_playing_join(fact: DataFrame, dim: DataFrame, dim_key: str, dim_label: str,
                      roles: dict[str, str], max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join the same dimension once per role: fact label column → output id column.

    The dimension is checked once; each role gets its own aliased copy.
    """
    side = lookup_side(dim.select(dim_key, dim_label), max_rows)
    for label_col, out_col in roles.items():
        d = side.select(F.col(dim_key).alias(out_col), F.col(dim_label).alias("__lbl"))
        fact = fact.join(d, fact[label_col] == d["__lbl"], "left").drop("__lbl")
    return fact


def append_missing(known: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Known members plus candidate keys absent from them (other columns null)."""
    missing = candidates.select(key).distinct().join(known.select(key), key, "left_anti")
    return known.unionByName(missing, allowMissingColumns=True)
