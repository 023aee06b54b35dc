"""Deterministic "first" and "last" per key.

Both are plain aggregates (``min_by`` / ``max_by``), so Spark combines them
map-side before the shuffle: a key holding a third of all rows is reduced in
every task first and never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _order_struct(order_by):
    """The ordinal, nulls last: each part is preceded by whether it is null."""
    parts = []
    for c in order_by:
        c = F.col(c) if isinstance(c, str) else c
        parts += [c.isNull(), c]
    return F.struct(*parts)


def keep_first(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """One row per ``keys``: the first in the declared ``order_by`` ordinal.

    Replaces an input-order ``drop_duplicates(keep='first')``, which has no
    meaning on a distributed table.  Null ordinals come last; rows equal in
    the ordinal are ordered by their other columns, so the choice is total.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    ordinal = F.struct(_order_struct(order_by), _order_struct(others))
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordinal).alias("__first"))
    return agg.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in others])


def latest_non_null(df: DataFrame, keys: list[str], value_cols: list[str],
                    order_by: list) -> DataFrame:
    """Per key, the last non-null value of each column in ``order_by`` order.

    Each column is resolved on its own, so the values of one output row may
    come from different input rows (``groupby().last()`` semantics).  A null
    ordinal sorts last and so wins, as in a sort with nulls last; of rows
    equal in the ordinal the larger value wins, so the order is total.
    """
    ord_ = _order_struct(order_by)
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(ord_, F.col(c)))).alias(c)
            for c in value_cols]
    return df.groupBy(*keys).agg(*aggs)
