r"""MinHash near-duplicates with tensored banding.

A document's set is its distinct five-word runs (lower-cased words; fewer
words: the whole text as one run).  Documents are linked if their sets'
Jaccard similarity is at least 0.85, and groups are what links connect.

Tables that ask for ``2 * ROWS`` equal minhashes each would need as many
minhashes per table.  Tensoring makes two collections of ``HALVES`` smaller
hashes (``ROWS`` minhashes each) and uses every pair of one from either as a
table: 64 tables of four minhashes from 32 minhashes instead of 256.  A pair
at similarity s meets in some table with probability
``(1 - (1 - s**2)**8)**2``: 0.99993 at 0.85 and 0.999997 at 0.9.

1. Equal sets are one class; only classes go on (a text copied a million
   times is one row).
2. Half keys of the first collection that no other class has are dropped
   before the tables are formed; that loses no pair.
3. The full sets of just the classes that share a table are read again.
   Classes too much of whose set no other candidate has can have no link and
   go (:func:`overlap_bound`); the bound is exact.
4. Buckets are linked by :func:`linking.linked_groups`; candidates are
   verified on the full sets.

Defined cases: a null or empty text, or one without words, has an empty set,
is linked with nothing and stays; rows with a null id take part, but never
give the group its id unless all ids are null; rows equal in id and text get
equal results; texts of any length count whole; columns named like a result
are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .arrays import LONG, SPACE_WORD, Slab, doc_of, field, gram_hashes, map_text, mix64, own_columns
from .linking import linked_groups, shared_buckets

SHINGLE = 5
HALVES, ROWS = 8, 2
PERCENT = 85
#: What the stage of the pipeline links; a pair there shares a table with probability 0.9994.
STAGE_PERCENT = 80
#: Sides up to this many rows of fixed size are broadcast.
MAX_BROADCAST_ROWS = 500_000

_U = np.uint64
LONGS = T.ArrayType(LONG, False)


def shingles(slab: Slab) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their texts, ordered by text, then hash."""
    starts, ends, first = slab.words(SPACE_WORD)
    h = slab.hashes(starts, ends, lower=True)
    g, at = gram_hashes(h, first, SHINGLE)
    words = np.diff(first)
    hashes, docs = [g], [doc_of(first)[at]]
    for k in range(1, SHINGLE):
        short = np.flatnonzero(words == k)
        if len(short):
            whole = np.full(len(short), k, dtype=_U)
            for j in range(k):
                whole = whole * _U(0xD6E8FEB86659FD93) + h[first[short] + j]
            hashes.append(mix64(whole))
            docs.append(short)
    g, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    return g[new], d[new]


def _longs(x: np.ndarray) -> pa.Array:
    """Rows of unsigned numbers as an array of long lists."""
    flat = np.ascontiguousarray(x).view(np.int64)
    off = pa.array(np.arange(x.shape[0] + 1, dtype=np.int32) * x.shape[1], pa.int32())
    return pa.ListArray.from_arrays(off, pa.array(flat.reshape(-1), pa.int64()))


def sketch_slab(slab: Slab) -> list:
    """Set size, set hash, and the two collections of half keys."""
    g, d = shingles(slab)
    size = np.bincount(d, minlength=slab.n)
    has = np.flatnonzero(size)
    begin = np.cumsum(size)[has] - size[has]
    whole, halves = np.zeros(slab.n, dtype=_U), np.zeros((slab.n, 2 * HALVES), dtype=_U)
    if len(has):
        whole[has] = mix64(np.add.reduceat(mix64(g + _U(99)), begin) + size[has].astype(_U))
        rng = np.random.default_rng(3)
        odd = rng.integers(1, 1 << 63, 2 * HALVES * ROWS, dtype=_U) * _U(2) + _U(1)
        for k in range(2 * HALVES):
            key = np.full(len(has), k, dtype=_U)
            for r in range(ROWS):
                # A product with an odd number orders the hashes anew; its least value is the minhash.
                key = mix64(key * _U(31) + np.minimum.reduceat(g * odd[k * ROWS + r], begin))
            halves[has, k] = key
    return [size, whole.view(np.int64), _longs(halves[:, :HALVES]), _longs(halves[:, HALVES:])]


SKETCH = [field("n_shingles", LONG), field("set_hash", LONG), field("left", LONGS), field("right", LONGS)]


def tensored_entries(classes: DataFrame) -> DataFrame:
    """Table entries (key, t, id) of classes (id, left, right)."""
    half = classes.select("id", "right", F.posexplode("left").alias("i", "l"))
    half = half.withColumn("half", F.xxhash64("i", "l"))
    met = half.groupBy("half").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("half")
    both = half.join(met, "half").select("id", "i", "half", F.posexplode("right").alias("j", "r"))
    return both.select(F.xxhash64("half", "j", "r").alias("key"), (F.col("i") * HALVES + F.col("j")).cast("int").alias("t"), "id")


def first_shared_table() -> Column:
    """Whether table ``t`` is the first that both sides' half keys (``xa``, ``xb``) share."""
    out = F.lit(True)
    for side, index in (("left", F.floor(F.col("t") / HALVES)), ("right", F.col("t") % HALVES)):
        for k in range(HALVES - 1):
            out = out & ((index <= k) | (F.col(f"xa.{side}")[k] != F.col(f"xb.{side}")[k]))
    return out


def overlap_bound(live: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The classes that can have a link at all: id, rank, w (size n, core c), x.

    ``c`` counts the shingles that some other candidate class has too.  An
    intersection is no larger than either core, so a pair needs
    ``(100 + percent) * min(c) >= percent * (n + n')``, and a class needs that
    with the smallest set it shares a bucket with.  Classes with a large core
    share rank first: the text that others were copied from.
    """
    alone = sets.select("id", F.explode("hashes").alias("h")).groupBy("h").agg(F.min("id").alias("id"), F.max("id").alias("y")) \
                .where("id = y").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    sized = sets.select("id", F.size("hashes").alias("n")).join(alone, "id", "left") \
                .select("id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"))
    met = live.join(sized, "id")
    smallest = met.groupBy("key").agg(F.min("n").alias("least"))
    least = met.join(smallest, "key").groupBy("id").agg(F.min("least").alias("least"))
    partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    nodes = sized.join(least, "id").where(F.lit(100 + percent) * F.col("c") >= F.lit(percent) * (F.col("n") + partner))
    share = F.floor(F.col("c") / F.col("n") * (1 << 20)).cast("long")
    rank = F.shiftleft(share, 42) + F.shiftrightunsigned(F.col("id"), 22)
    return nodes.join(classes.select("id", "left", "right"), "id").select(
        "id", rank.alias("rank"), F.struct("n", "c").alias("w"), F.struct("left", "right").alias("x")).checkpoint()


def _sets(docs: DataFrame, id_col: str, text: str, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the wanted classes (key, id): id, hashes."""
    keyed = docs.select(F.xxhash64(id_col, text).alias("key"), F.col(text).alias("text"))
    wanted = F.broadcast(wanted) if wanted.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else wanted
    rows = keyed.join(wanted, "key")

    def run(slab: Slab):
        g, d = shingles(slab)
        off = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=slab.n))])
        return [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(g.view(np.int64), pa.int64()))]

    # Repeated rows give equal sets; one is enough.
    return map_text(rows, "text", ["id"], [field("hashes", LONGS)], lambda: run).dropDuplicates(["id"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT,
                    carry: list[str] | None = None) -> DataFrame:
    """``docs`` (the ``carry`` columns) with n_shingles, component_id and kept."""
    ensure_checkpoint_dir(docs.sparkSession)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("n_shingles", "component_id", "kept")]
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text).alias("key"), F.col(text).alias("text"))
    sketches = map_text(slim, "text", ["id", "key"], SKETCH, lambda: sketch_slab).checkpoint()
    classes = sketches.where("n_shingles > 0").groupBy(F.col("set_hash")).agg(
        F.min("id").alias("least"), F.min("key").alias("key"),
        F.any_value("left").alias("left"), F.any_value("right").alias("right")).withColumnRenamed("set_hash", "id").checkpoint()
    live = shared_buckets(tensored_entries(classes))
    sets = _sets(docs, id_col, text, live.select("id").distinct().join(classes.select("id", "key"), "id")).checkpoint()

    def verify(pairs: DataFrame) -> DataFrame:
        # The members first: the centre, which many pairs share, meets rows that are large enough to be split as skewed.
        side = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
        hub = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
        common = F.size(F.array_intersect("ha", "hb"))
        both = pairs.join(side, "b").join(hub, "a").select("a", "b", common.alias("c"), (F.size("ha") + F.size("hb")).alias("s"))
        return both.where(F.lit(100) * F.col("c") >= F.lit(percent) * (F.col("s") - F.col("c")))

    # No intersection is larger than the smaller set or the smaller core.
    most = F.least("wa.c", "wb.c")
    plausible = F.lit(100 + percent) * most >= F.lit(percent) * (F.col("wa.n") + F.col("wb.n"))
    nodes = overlap_bound(live, classes, sets, percent)
    groups = linked_groups(live, nodes, verify, plausible, first_shared_table())
    named = classes.select("id", "least").join(groups, "id", "left").select("id", "least", F.coalesce("component", "id").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "component").select(F.col("id").alias("set_hash"), "component_id").checkpoint()
    verdicts = sketches.select("id", "key", "n_shingles", "set_hash").join(of_class, "set_hash", "left")
    verdicts = verdicts.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "n_shingles",
                               F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    kept = F.col("component_id").eqNullSafe(F.col(id_col)).alias("kept")
    if set(carry) <= {id_col}:
        verdicts = verdicts.withColumnRenamed("__id", id_col)
        return verdicts.select(*carry, "n_shingles", "component_id", kept)
    # Rows equal in id and text have one verdict, so the join adds no rows.
    verdicts = verdicts.dropDuplicates(["__id", "__key"])
    keyed = docs.select(*[F.col(f"`{c}`") for c in carry], F.xxhash64(id_col, text).alias("__k"), F.col(id_col).alias("__i"))
    out = keyed.join(verdicts, (F.col("__k") == F.col("__key")) & F.col("__i").eqNullSafe(F.col("__id")))
    return out.select(*carry, "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("__i")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The stage of the pipeline: one document of each group of similarity 0.8 or more, the one with the smallest id."""
    return own_columns(docs, lambda own, at: near_duplicates(own, at["doc_id"], at["text"], percent=STAGE_PERCENT).where("kept"))


def op3_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, carry=["doc_id"])
