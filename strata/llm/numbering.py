"""Numbers from 0 inside groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task numbers, at most about.
PART_ROWS = 50_000


def parts_for(rows: int, groups: int = 1) -> int:
    """Parts to deal each group into, for groups of about equal size; never fewer than 64, for hot ones."""
    return max(64, -(-rows // (max(1, groups) * PART_ROWS)))


def number_within(df: DataFrame, groups: list[str], order: list[str], parts: int, out: str) -> DataFrame:
    """``df`` with the long ``out``: 0, 1, 2 ... inside each group, gapless.

    Rows are dealt by a hash of ``order`` into ``parts`` parts of each group
    and numbered there; a part starts where the counts of the parts before it
    end.  ``df`` is computed twice, so it should be materialised; rows equal
    in ``order`` are interchangeable.
    """
    df = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    counts = df.groupBy(*groups, "__part").agg(F.count(F.lit(1)).alias("__n"))
    below = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, "__part", F.coalesce(F.sum("__n").over(below), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*groups, "__part").orderBy(*order)
    numbered = df.withColumn("__rn", F.row_number().over(inside))
    return numbered.join(starts, [*groups, "__part"]).withColumn(out, (F.col("__start") + F.col("__rn") - 1).cast("long")) \
                   .drop("__part", "__rn", "__start")
