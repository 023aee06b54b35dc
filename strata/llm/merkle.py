"""A Merkle manifest of a dataset by time-forward processing.

Each row is a leaf, the hash of its fields.  Per tree (say, per language) the
leaves ascend in a given order, and every ``FANOUT`` consecutive nodes become
one until one node remains, the subroot; the subroots become the root in the
same way.  Each leaf gets its proof: the siblings of each level on its way to
the root.

Time-forward processing takes the nodes in the order of their labels (level,
then place) and sends each one's digest forward to its parent through a
priority queue, whose least label is what comes next.  The queue is external:
labels are cut into epochs of ``EPOCH_LEVELS`` levels and blocks of
``FANOUT ** EPOCH_LEVELS`` places, messages between epochs are rows that Spark
shuffles by block and sorts by place, and in a task a heap holds what one
block sends itself (:class:`ForwardQueue`).  The reversed sweep takes the
labels from the last to the first: a node receives the rest of its proof from
its parent and sends it, with the siblings put before, to its children.

A task holds one block, whatever the size of a tree, and there are
log(leaves) / EPOCH_LEVELS epochs.  Leaves get their places by a distributed
sort (:func:`ordered_places`), so a tree that has most rows is spread over
tasks like any other.  Texts are read once, for the leaves.

Defined cases: a null field is ``-`` in the hash; a null tree key is a tree of
its own and comes first, null order values come first; rows equal in the
order column are ordered by their leaf hash, so rows that still tie are equal
and their proofs interchangeable; texts of any length count whole; a lone
leaf is its tree's subroot, a lone subroot the root; an empty table has no
rows and no root; columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

FANOUT = 2
#: Levels of an epoch: a block has 4,096 nodes at its lowest level.
EPOCH_LEVELS = 12

STEP = T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
PROOF = T.ArrayType(STEP)
TREE, PLACE, SIZE, DIGEST = "__tree", "__place", "__size", "__digest"


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(fields: list[Column]) -> Column:
    """The hash of a row: each field is ``-`` if null, else its UTF-8 length, a colon and its value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_hash(proof: Column) -> Column:
    """The hash of all siblings of a proof, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


class ForwardQueue:
    """Messages to nodes, received in the order of the receivers' labels."""

    def __init__(self):
        self.heap: list[tuple] = []

    def send(self, label: tuple[int, int], slot: int, message) -> None:
        heappush(self.heap, (label, slot, message))

    def next(self) -> tuple[tuple[int, int], list]:
        """The least label that has messages, and they by their slots."""
        label, got = self.heap[0][0], []
        while self.heap and self.heap[0][0] == label:
            got.append(heappop(self.heap)[2])
        return label, got


def levels_left(size: int, fanout: int = FANOUT) -> int:
    """Levels above ``size`` nodes."""
    n = 0
    while size > 1:
        size, n = -(-size // fanout), n + 1
    return n


def forward(digests: list[str], levels: int, fanout: int = FANOUT) -> dict[tuple[int, int], list[str]]:
    """The children's digests of each inner node (level, place) of a block, whose top is (levels, 0)."""
    queue, children = ForwardQueue(), {}
    for k, digest in enumerate(digests):
        queue.send((1, k // fanout), k % fanout, digest)
    while queue.heap:
        (level, k), got = queue.next()
        children[level, k] = got
        if level < levels:
            queue.send((level + 1, k // fanout), k % fanout, digest_of(got))
    return children


def backward(children: dict[tuple[int, int], list[str]], levels: int, rest: list[tuple[str, str]], fanout: int = FANOUT) -> list[list]:
    """The proof of each place at level 0, given the rest of the proof from the top of the block on."""
    queue, proofs = ForwardQueue(), []
    queue.send((-levels, 0), 0, None)
    while queue.heap:
        (level, place), (above,) = queue.next()
        level = -level
        if not level:
            # From the level nearest to the leaf up.
            steps = []
            while above is not None:
                step, above = above
                steps.append(step)
            proofs.append(steps + rest)
            continue
        got = children[level, place]
        for slot in range(len(got)):
            step = ("".join(got[:slot]), "".join(got[slot + 1:]))
            queue.send((1 - level, place * fanout + slot), 0, (step, above))
    return proofs


def ordered_places(df: DataFrame, group: str, order: list[Column], place: str = PLACE, size: str = SIZE) -> DataFrame:
    """``df`` with each row's place (from 0) in its group, and the group's size.  Checkpointed.

    One range sort over (group, order); a partition's rows of a group are
    counted and start where those of the partitions before it end.
    """
    ensure_checkpoint_dir(df.sparkSession)
    at = F.monotonically_increasing_id()
    rows = df.orderBy(F.col(group), *order).withColumn("__pid", F.spark_partition_id()).withColumn("__at", at).checkpoint()
    runs = rows.groupBy(group, "__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__from"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(group, "__pid", "__from", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
                       F.sum("__n").over(whole).alias(size))
    return rows.join(runs, [group, "__pid"]).withColumn(place, F.col("__at") - F.col("__from") + F.col("__start")) \
               .drop("__pid", "__at", "__from", "__start")


class Forest:
    """Trees over rows (TREE, PLACE, SIZE, DIGEST): their roots, and the proofs within them."""

    def __init__(self, leaves: DataFrame, fanout: int = FANOUT, epoch_levels: int = EPOCH_LEVELS):
        """The forward sweep: an epoch at a time, until every tree has one node."""
        self.fanout, self.epoch_levels, self.block = fanout, epoch_levels, fanout ** epoch_levels
        self.epochs: list[DataFrame] = []
        nodes = leaves
        while True:
            self.epochs.append(nodes)
            if (nodes.agg(F.max(SIZE)).first()[0] or 0) <= 1:
                break
            nodes = self._up(nodes)

    def roots(self) -> DataFrame:
        """TREE and DIGEST of each tree's root."""
        ended = [nodes.where(F.col(SIZE) == 1).select(TREE, DIGEST) for nodes in self.epochs]
        out = ended[0]
        for more in ended[1:]:
            out = out.unionByName(more)
        return out

    def _blocks(self, nodes: DataFrame) -> DataFrame:
        return nodes.where(F.col(SIZE) > 1).withColumn("__block", F.floor(F.col(PLACE) / F.lit(self.block)).cast("long"))

    def _up(self, nodes: DataFrame) -> DataFrame:
        fanout, epoch_levels, block = self.fanout, self.epoch_levels, self.block
        schema = T.StructType([nodes.schema[TREE]] + [T.StructField(c, T.LongType()) for c in (PLACE, SIZE)] + [T.StructField(DIGEST, T.StringType())])

        def top(key, table):
            table = table.sort_by(PLACE)
            size = table[SIZE][0].as_py()
            levels = min(epoch_levels, levels_left(size, fanout))
            children = forward(table[DIGEST].to_pylist(), levels, fanout)
            return pa.table({TREE: pa.array([key[0].as_py()], pa.string()), PLACE: pa.array([key[1].as_py()], pa.int64()),
                             SIZE: pa.array([-(-size // block)], pa.int64()), DIGEST: [digest_of(children[levels, 0])]})

        slim = self._blocks(nodes).select(TREE, PLACE, SIZE, DIGEST, "__block")
        return slim.groupBy(TREE, "__block").applyInArrow(top, schema).checkpoint()

    def proofs(self, above: DataFrame) -> DataFrame:
        """The leaves' rows with ``proof`` and the columns of ``above``.

        ``above`` has a row per tree: TREE, proof (of the tree's root) and
        what is to be handed down to all its leaves.  The reversed sweep, an
        epoch at a time from the last.
        """
        down = None
        for nodes in reversed(self.epochs):
            tops = above.join(nodes.where(F.col(SIZE) == 1).drop(DIGEST) if nodes is not self.epochs[0] else nodes.where(F.col(SIZE) == 1), TREE)
            if down is None:
                down = tops
                continue
            got = self._down(nodes, down.drop(SIZE))
            down = got.unionByName(tops.select(*got.columns))
        return down

    def _down(self, nodes: DataFrame, tops: DataFrame) -> DataFrame:
        fanout, epoch_levels = self.fanout, self.epoch_levels
        keep = [c for c in nodes.columns if c != DIGEST or nodes is self.epochs[0]]
        handed = [c for c in tops.columns if c not in (TREE, PLACE, "proof")]
        schema = T.StructType([nodes.schema[c] for c in keep] + [tops.schema[c] for c in handed] + [T.StructField("proof", PROOF)])

        def deliver(table, top):
            table = table.sort_by(PLACE)
            levels = min(epoch_levels, levels_left(table[SIZE][0].as_py(), fanout))
            rest = [(s["before"], s["after"]) for s in top["proof"][0].as_py()]
            proofs = backward(forward(table[DIGEST].to_pylist(), levels, fanout), levels, rest, fanout)
            n = [0]
            for steps in proofs:
                n.append(n[-1] + len(steps))
            flat = [pa.array([s[k] for steps in proofs for s in steps], pa.string()) for k in (0, 1)]
            proof = pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.StructArray.from_arrays(flat, ["before", "after"]))
            out = {c: table[c] for c in keep}
            for c in handed:
                out[c] = pa.array([top[c][0].as_py()] * len(table), top[c].type)
            return pa.table(out | {"proof": proof})

        left = self._blocks(nodes).groupBy(TREE, "__block")
        # Both sides come from the same rows; new names keep their columns apart.
        right = tops.toDF(*["__block" if c == PLACE else c for c in tops.columns]).groupBy(TREE, "__block")
        return left.cogroup(right).applyInArrow(deliver, schema)


def manifest(docs: DataFrame, fields: list[str], tree: str, order: str, carry: dict[str, Column],
             fanout: int = FANOUT, epoch_levels: int = EPOCH_LEVELS) -> DataFrame:
    """The ``carry`` columns of each row with leaf, subroot, root (hex) and proof.

    ``proof`` lists, from the leaf up, the digests before and after the node
    on its level's run, joined; both are empty where a node goes up alone.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    carry = {name: c for name, c in carry.items() if name not in ("leaf", "subroot", "root", "proof")}
    # A tree key as a text that is never null; null comes first.
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{tree}`").cast("string")), F.lit("")).alias(TREE),
                       F.col(f"`{order}`").alias("__order"), leaf_hash([F.col(f"`{c}`") for c in fields]).alias(DIGEST),
                       *[c.alias(name) for name, c in carry.items()])
    rows = ordered_places(rows, TREE, [F.col("__order").asc_nulls_first(), F.col(DIGEST).asc()]).drop("__order").checkpoint()
    trees = Forest(rows, fanout, epoch_levels)
    # The subroots are the leaves of one more tree.
    subroots = trees.roots().select(F.lit("").alias("__all"), F.col(TREE).alias("__key"), DIGEST)
    subroots = ordered_places(subroots, "__all", [F.col("__key").asc()]).withColumnRenamed("__all", TREE).checkpoint()
    top = Forest(subroots, fanout, epoch_levels)
    empty = F.array().cast(PROOF)
    root = top.roots().select(TREE, F.col(DIGEST).alias("root"), empty.alias("proof"))
    above = top.proofs(root).select(F.col("__key").alias(TREE), F.col(DIGEST).alias("subroot"), "root", "proof").checkpoint()
    out = trees.proofs(above)
    return out.select(*[F.col(f"`{c}`") for c in carry],
                      F.col(DIGEST).alias("leaf"), "subroot", "root", "proof")


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as leaves, with the hash of their proofs, and the check of leaves some of which were tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*LEAF_FIELDS)
    altered = leaf_hash([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF_FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, LEAF_FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id"), "__tampered": F.when(chosen, altered)})
    fold = folded(F.coalesce("__tampered", "leaf"), F.col("proof"))
    out = rows.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"), fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(fields: list[str]) -> str:
    value = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    return f"sha256({' || '.join(value.format(f) for f in fields)})"


#: The recursion makes a level of all trees at a time; the CRC-32 of the id is worked out bit by bit, as SQL lacks it.
OP12_SQL = f"""
WITH RECURSIVE base AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql(LEAF_FIELDS)} AS leaf,
           {_leaf_sql(["(n_chars + 1)" if f == "n_chars" else f for f in LEAF_FIELDS])} AS altered,
           list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                       lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
    FROM documents
), placed AS (
    SELECT doc_id, g, leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN altered ELSE leaf END AS start,
           row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n
    FROM base
), node AS (
    SELECT 0 AS lvl, g, i, n, leaf AS h FROM placed
    UNION ALL
    SELECT lvl + 1, g, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY lvl, g, i // 2, n
), subroot AS (
    SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1
), top AS (
    SELECT 0 AS lvl, i, n, subroot AS h FROM subroot
    UNION ALL
    SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 2, n
), step AS (
    SELECT p.g, p.i, l.lvl, p.i >> l.lvl AS pos, s.h
    FROM placed p JOIN (SELECT DISTINCT g, lvl FROM node WHERE n > 1) l ON l.g = p.g
    LEFT JOIN node s ON s.g = p.g AND s.lvl = l.lvl AND s.i = xor(p.i >> l.lvl, 1)
    UNION ALL
    SELECT p.g, p.i, 1000 + l.lvl, r.i >> l.lvl, s.h
    FROM placed p JOIN subroot r ON r.g = p.g CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) l
    LEFT JOIN top s ON s.lvl = l.lvl AND s.i = xor(r.i >> l.lvl, 1)
), proof AS (
    SELECT g, i, sha256(string_agg(coalesce(h, ''), '' ORDER BY lvl)) AS proof_sha256,
           list((CASE WHEN pos % 2 = 1 THEN coalesce(h, '') ELSE '' END) || '|' || (CASE WHEN pos % 2 = 0 THEN coalesce(h, '') ELSE '' END) ORDER BY lvl) AS steps
    FROM step GROUP BY g, i
), result AS (
    SELECT p.doc_id, p.leaf, r.subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(f.proof_sha256, sha256('')) AS proof_sha256,
           CASE WHEN f.steps IS NULL THEN p.start
                ELSE list_reduce([p.start] || f.steps, lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) END AS folded_root
    FROM placed p JOIN subroot r ON r.g = p.g LEFT JOIN proof f ON f.g = p.g AND f.i = p.i
)
SELECT *, folded_root = root AS verified FROM result
"""
