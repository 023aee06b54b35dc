"""Unions, role views, unpivots and explodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_columns(sources: list[tuple[DataFrame, list[str]]], name: str) -> DataFrame:
    """Union-all of many columns into one column ``name``.

    Columns of the same table are stacked with ``explode(array(...))`` so each
    table is scanned once, whatever the number of its columns.
    """
    parts = [df.select(F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias(name))
             for df, cols in sources if cols]
    return reduce(DataFrame.unionAll, parts)


def role_union(df: DataFrame, roles: list[dict[str, object]], keep: list[str] = ()) -> DataFrame:
    """Long view of a fact whose rows play several roles (home / away).

    ``roles`` holds one mapping per role: output column → input column name or
    Column.  One scan of the fact produces all role rows.
    """
    def col(v):
        return F.col(v) if isinstance(v, str) else v

    names = list(roles[0].keys())
    structs = [F.struct(*[col(r[n]).alias(n) for n in names]) for r in roles]
    return df.select(*keep, F.inline(F.array(*structs)))


def unpivot_tagged(df: DataFrame, specs: list[tuple[str, dict]], value_name: str,
                   keep: list[str], skip_null: bool = False) -> DataFrame:
    """Wide → long: each listed column becomes rows tagged with constants.

    ``skip_null`` leaves null cells out before the rows are made.

    ``specs`` is an ordered list of (source column, {tag: value}); columns that
    are absent from ``df`` are skipped.  ``source_ordinal`` keeps the position
    of the column in ``specs`` for stable ordering downstream.
    """
    present = [(i, c, tags) for i, (c, tags) in enumerate(specs) if c in df.columns]
    if not present:
        # Nothing to unpivot: no rows, in the usual columns.
        tags = {t: F.lit(v) for t, v in (specs[0][1] if specs else {}).items()}
        return df.select(*keep, F.lit(0).alias("source_ordinal"), *[v.alias(t) for t, v in tags.items()],
                         F.lit(None).cast("string").alias(value_name)).where(F.lit(False))
    tag_names = list(present[0][2].keys())
    structs = [F.struct(F.lit(i).alias("source_ordinal"),
                        *[F.lit(tags[t]).alias(t) for t in tag_names],
                        F.col(c).cast("string").alias(value_name))
               for i, c, tags in present]
    if skip_null:
        structs = [F.when(F.col(c).isNotNull(), x) for x, (_, c, _) in zip(structs, present, strict=True)]
        return df.select(*keep, F.inline(F.array_compact(F.array(*structs))))
    return df.select(*keep, F.inline(F.array(*structs)))


def explode_with_position(df: DataFrame, array_col, keep: list[str],
                          pos_name: str = "position", value_name: str = "item") -> DataFrame:
    """One row per array element, keeping its position (empty arrays give no rows)."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(*keep, F.posexplode(arr).alias(pos_name, value_name))
