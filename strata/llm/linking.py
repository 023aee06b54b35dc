"""Connected groups of rows that share hash keys, without pairing everyone in a bucket.

A candidate generator gives entries (key, id): rows that share a key may be
linked.  All pairs of a bucket would be quadratic, so buckets are worked off
in waves.  In a wave some members of each bucket are its centres; every
member is compared with them, the pairs are verified exactly, and the groups
found so far are joined up.  A centre has then been compared with its whole
bucket and leaves it; a bucket whose members are all in one group is done,
for nothing in it can change the result.  What is left goes to the next wave
with more centres, and small buckets are compared in full, so in the end
every pair that shares a key is verified or already connected: the groups
are exactly those of all verified pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.partitions import hadoop_path

#: Buckets of at most this many members are compared in full after the first wave.
SMALL_BUCKET = 128
#: Centres of larger buckets in the second wave; eight times as many in each later one.
CENTRES = 128


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, until :func:`discard`."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`stored`, once all that reads it is written."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path, fs = hadoop_path(table.sparkSession, folder)
        fs.delete(path, True)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every linked id the smallest id it can reach.

    Alternates two rounds until nothing changes: each node's larger
    neighbours move to its smallest one, then its smaller ones do.  Minima
    are combined map-side and edges of a hub are spread by skew joins.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("r")).select("u", F.least("u", "r").alias("r"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("r").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("r"))
        hooks = large.join(low, "u").where("v <> r").select(F.col("v").alias("u"), F.col("r").alias("v"))
        edges = hooks.union(low.select("u", F.col("r").alias("v"))).distinct().checkpoint()
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _joined_up(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` once ``links`` are added: only the groups that the links touch are worked on."""
    if links.isEmpty():
        return groups
    side = lambda c: groups.select(F.col("id").alias(c), F.col("component").alias(f"g{c}"))
    named = links.join(side("a"), "a", "left").join(side("b"), "b", "left")
    merged = components(named.select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")))
    new = merged.select(F.col("id").alias("component"), F.col("component").alias("now"))
    old = groups.join(new, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    return old.union(merged.join(groups.select("id"), "id", "left_anti")).checkpoint()


def shared_buckets(entries: DataFrame) -> DataFrame:
    """The entries (key, t, id) of keys that two ids or more share.  Checkpointed."""
    buckets = entries.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("key")
    return entries.join(buckets, "key").checkpoint()


def linked_groups(live: DataFrame, nodes: DataFrame, verify: Callable[[DataFrame], DataFrame], plausible: Column,
                  canonical: Column | None = None) -> DataFrame:
    """The components (id, component) of the verified links of all pairs that share a key.

    ``live``: key, t (the table a key belongs to), id.  ``nodes``: id, rank (a
    long; the highest in a bucket is its first centre), w (what ``plausible``
    needs of the two sides, ``wa`` and ``wb``, to rule a pair out exactly) and
    x (what ``canonical`` needs, ``xa`` and ``xb``, to tell whether ``t`` is
    the first table the two share, so that a pair in many buckets is made
    once; without it, the entries stay short).  ``verify`` takes pairs (a, b) and returns those that are links.
    """
    live = before = stored(live.join(nodes.select("id", "rank", "w"), "id").distinct(), "link-entries")
    top = live.groupBy("key").agg(F.max("rank").alias("top"), F.min("rank").alias("low")).where("top <> low").select("key", "top")
    live = live.join(top, "key").withColumn("hub", F.col("rank") == F.col("top")).drop("top", "rank")
    live = stored(live, "link-entries")
    discard(before)
    hubs = live.where("hub").select("key", F.col("id").alias("a"), F.col("w").alias("wa"))
    pairs = live.where("not hub").select("key", F.col("id").alias("b"), F.col("w").alias("wb")).join(hubs, "key").where(plausible)
    groups, wave = None, 0
    while True:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        good = verify(pairs).select("a", "b").checkpoint()
        groups = components(good) if groups is None else _joined_up(groups, good)
        # A centre was compared with its bucket and leaves it; buckets within one group are done.
        rest = live.where("not hub").select("key", "t", "id", "w").join(groups, "id", "left") \
                   .select("key", "t", "id", "w", F.coalesce("component", "id").alias("group"))
        open_ = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("group").alias("g0"), F.max("group").alias("g1")) \
                    .where("g0 <> g1").select("key", "n")
        wave += 1
        share = F.when(F.col("n") <= SMALL_BUCKET, F.lit(1)).otherwise(F.ceil(F.col("n") / F.lit(CENTRES * 8 ** (wave - 1))))
        before, live = live, stored(rest.join(open_, "key").withColumn("hub", F.pmod(F.xxhash64("id", F.lit(wave)), share) == 0), "link-entries")
        discard(before)
        # Shuffle files of the waves behind us go once nothing refers to them.
        live.sparkSession.sparkContext._jvm.System.gc()
        if live.isEmpty():
            discard(live)
            return groups
        full, x = (live, []) if canonical is None else (live.join(nodes.select("id", "x"), "id"), ["x"])
        side = lambda c: [F.col(name).alias(short + c) for name, short in [("id", ""), ("w", "w"), ("group", "g"), *zip(x, x, strict=True)]]
        hubs, members = full.where("hub").select("key", *side("a")), full.select("key", "t", *side("b"), "hub")
        # Two centres meet once, a centre and a member once.
        once = (F.col("ga") != F.col("gb")) & (~F.col("hub") | (F.col("a") < F.col("b")))
        pairs = members.join(hubs, "key").where(once & plausible if canonical is None else once & plausible & canonical)
