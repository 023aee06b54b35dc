"""Bounded samples of labelled documents, for the operators that learn."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LONG, SPACE_WORD, Slab, field, gram_hashes, map_text


def held_out(id_col: str) -> Column:
    """True for the rows kept for testing: crc32 of the id as text, modulo 4, is 2 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled_ids(labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_class`` training ids of each class, chosen by a hash of the id: ``id_col``, ``y``.

    Held-out ids and null labels are left out; an id labelled both ways is left out too.
    """
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col))
    rows = rows.groupBy(id_col).agg(F.min(label).alias("y"), F.max(label).alias("__y")).where("y = __y").drop("__y")
    pick = [rows.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(per_class) for y in (1, 0)]
    return pick[0].union(pick[1])


def sketch_slab(slab: Slab) -> list[np.ndarray]:
    """Per text the least hash of its five-word runs (of its words, if fewer): near copies mostly share it."""
    starts, ends, first = slab.words(SPACE_WORD)
    h = slab.hashes(starts, ends, lower=True)
    g, at = gram_hashes(h, first, 5)
    out = np.full(slab.n, -1, dtype=np.int64)
    for values, where in ((h, np.arange(len(h))), (g, at)):
        if len(values):
            low = np.full(slab.n, np.iinfo(np.uint64).max, dtype=np.uint64)
            np.minimum.at(low, np.searchsorted(first, where, "right") - 1, values)
            has = low != np.iinfo(np.uint64).max
            out[has] = low[has].view(np.int64)
    return [out]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Texts of the sampled ids (id, text, y), of near copies of a class the one with the least id; checkpointed.

    A text and a copy of it of the other class both stay: what tells them
    apart is what there is to learn.  The ids are at most ``2 * per_class``, so they are broadcast.
    """
    ids = labelled_ids(labels, label, per_class, id_col)
    rows = docs.select(F.col(id_col), F.col(text).alias("text")).join(F.broadcast(ids), id_col)
    rows = map_text(rows, "text", [id_col, "text", "y"], [field("__sketch", LONG)], lambda: sketch_slab)
    least = F.min_by(F.struct(id_col, "text"), F.struct(id_col, "text")).alias("one")
    return rows.groupBy("__sketch", "y").agg(least).select(f"one.{id_col}", "one.text", "y").checkpoint()
