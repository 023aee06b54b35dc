r"""Shards by k-d tree over document metadata.

The corpus is split recursively: a node's rows are ordered along the
dimension in which the node is widest, and cut at the weighted median (the
weight of a row is its bytes; a node for ``k`` shards is cut at
``floor(k/2)/k`` of its weight) until each leaf holds the target bytes.
Dimensions are the source, the language, the size and the document id, each
mapped to an order-preserving long and measured in shares of the corpus's
own range.  Rows equal in a dimension are ordered by the checksum of their
text and then by id, so equal texts stay side by side and a hot value (one
source with a third of all rows) can still be cut anywhere.

All nodes of a level are cut together.  Quantiles of the order give
candidate cuts, one aggregation weighs the slices between them, and a second
round does the same inside the slice where the target falls; the driver sees
a few thousand numbers a node whatever the corpus.  A row's shard is then a
function of its own columns and the tree (a few arrays), so nothing is
joined.  ``slot`` counts a shard's rows from 0: rows are numbered inside
small hash parts of a shard and the parts' counts are summed, so no task
holds a shard.

Defined cases: a null text has no bytes, every row weighs 16 more; null
metadata sorts first; rows equal in all (same id and text) stay together;
empty tables give empty results; texts of any length are one row; columns
named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes counted for a row besides its text.
ROW_BYTES = 16
#: Quantiles a node is weighed at in each round.
SLICES = 512
#: Rows numbered by one task when slots are given out, at most about.
PART_ROWS = 50_000

DIMS = ["__source", "__lang", "__size", "__id"]
ORDER = ["__crc", "__id"]


def _text_rank(c: str) -> Column:
    """The first seven bytes of a string as an order-preserving long; null is -1."""
    seven = F.rpad(F.substring(F.col(c).cast("string").cast("binary"), 1, 7), 7, F.lit(b"\x00"))
    return F.coalesce(F.conv(F.hex(seven), 16, 10).cast("long"), F.lit(-1).cast("long"))


def coordinates(docs: DataFrame, id_col: str, text: str, source: str, lang: str) -> dict[str, Column]:
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(ROW_BYTES)
    rank = lambda c: _text_rank(c) if c in docs.columns else F.lit(-1).cast("long")
    return {"__source": rank(source), "__lang": rank(lang), "__size": size,
            "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")),
            "__crc": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))}


class Tree:
    """Inner nodes as arrays; a leaf is its shard number."""

    def __init__(self):
        self.dim, self.cut, self.kids = [], [], []

    def add(self, dim: int, cut: tuple[int, int, int]) -> int:
        self.dim.append(dim)
        self.cut.append(cut)
        self.kids.append([None, None])
        return len(self.dim) - 1

    def route(self, cols: dict[str, np.ndarray], top) -> np.ndarray:
        """For each row the node it ends in: leaves and open nodes, as numbers from ``top`` downwards."""
        n = len(cols["__id"])
        out = np.zeros(n, dtype=np.int64)
        stack = [(top, np.arange(n))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            kind, at = node
            if kind != "inner":
                out[rows] = at
                continue
            left = before(cols[DIMS[self.dim[at]]][rows], cols["__crc"][rows], cols["__id"][rows], self.cut[at])
            stack += [(self.kids[at][0], rows[left]), (self.kids[at][1], rows[~left])]
        return out


def before(v: np.ndarray, crc: np.ndarray, ident: np.ndarray, cut: tuple[int, int, int]) -> np.ndarray:
    """Rows at or before a cut in the order (value, checksum, id)."""
    a, b, c = cut
    return (v < a) | ((v == a) & ((crc < b) | ((crc == b) & (ident <= c))))


def _routed(meta: DataFrame, tree: Tree, top) -> DataFrame:
    cols = [*DIMS, "__crc"]

    @F.pandas_udf("long")
    def node(source: pd.Series, lang: pd.Series, size: pd.Series, ident: pd.Series, crc: pd.Series) -> pd.Series:
        return pd.Series(tree.route(dict(zip(cols, (x.to_numpy() for x in (source, lang, size, ident, crc)), strict=True)), top))

    return meta.withColumn("__node", node(*cols))


def build_tree(meta: DataFrame, shards: int) -> tuple[Tree, tuple]:
    """The tree over ``meta`` (DIMS, checksum): inner nodes, and the top node."""
    tree, top = Tree(), ("open", 0)
    wide = meta.agg(*[F.min(d).alias(f"a{d}") for d in DIMS], *[F.max(d).alias(f"b{d}") for d in DIMS]).first()
    if wide[0] is None or shards == 1:
        return tree, ("leaf", 0)
    spans = [max(1, wide[f"b{d}"] - wide[f"a{d}"]) for d in DIMS]
    # Open nodes: number -> (first shard, shards, place of the node: parent and side).
    todo, number = {0: (0, shards, None)}, 1
    while todo:
        rows = _routed(meta, tree, top).where(F.col("__node").isin(list(todo)))
        ranges = rows.groupBy("__node").agg(
            F.sum("__size").alias("w"), *[F.min(d).alias(f"a{d}") for d in DIMS], *[F.max(d).alias(f"b{d}") for d in DIMS])
        ranges = {r["__node"]: r for r in ranges.collect()}
        plan = {}
        for node, (_, k, _) in todo.items():
            r = ranges.get(node)
            dim = 0 if r is None else int(np.argmax([(r[f"b{d}"] - r[f"a{d}"]) / s for d, s in zip(DIMS, spans, strict=True)]))
            plan[node] = (dim, (k // 2) / k * (r["w"] if r is not None else 0))
        cuts = _cuts(rows, plan)
        opened = {}
        for node, (shard, k, place) in todo.items():
            at = ("inner", tree.add(plan[node][0], cuts.get(node, (0, 0, 0))))
            if place is None:
                top = at
            else:
                tree.kids[place[0]][place[1]] = at
            for side, (s, m) in enumerate(((shard, k // 2), (shard + k // 2, k - k // 2))):
                if m == 1:
                    tree.kids[at[1]][side] = ("leaf", s)
                else:
                    # Open nodes get numbers beyond all shards, so a leaf is never taken for one.
                    tree.kids[at[1]][side] = ("open", shards + number)
                    opened[shards + number] = (s, m, (at[1], side))
                    number += 1
        todo = opened
    return tree, top


def _summary(node, v, c, i, w) -> pd.DataFrame:
    """At most SLICES + 1 points a node, evenly spread by weight: each stands for the rows since the last one."""
    if not len(node):
        return pd.DataFrame({x: np.zeros(0, dtype=np.int64) for x in ("node", "v", "c", "i", "w")})
    order = np.lexsort((i, c, v, node))
    node, v, c, i, w = (x[order] for x in (node, v, c, i, w))
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    keep = []
    for a, b in zip(first, np.r_[first[1:], len(node)], strict=True):
        total = np.cumsum(w[a:b])
        piece = total * SLICES // max(1, total[-1])
        keep.append(a + np.flatnonzero(np.r_[piece[1:] != piece[:-1], True]))
    at = np.concatenate(keep)
    sums = np.add.reduceat(w, np.r_[0, at[:-1] + 1])
    return pd.DataFrame({"node": node[at], "v": v[at], "c": c[at], "i": i[at], "w": sums})


SUMMARY = "node long, v long, c long, i long, w long"


def _cuts(rows: DataFrame, plan: dict[int, tuple[int, float]]) -> dict[int, tuple[int, int, int]]:
    """For each node the order value (dimension, checksum, id) at which its weight reaches the target.

    Every partition sums up its rows in SLICES points a node; a few tasks sum up those points, and
    the driver reads the last ones.  That tells the target's place to about 2/SLICES of the node; the
    second round looks only between those two points and ends within (2/SLICES)**2 or one row.
    """
    cols = ["__node", "__size", "__crc", *DIMS]
    cols = list(dict.fromkeys(cols))
    bounds: dict[int, tuple] = {}
    parts = max(1, round(rows.rdd.getNumPartitions() ** 0.5))
    cuts: dict[int, tuple[int, int, int]] = {}
    for last in (False, True):
        def local(pdfs, bounds=dict(bounds)):  # noqa: B006
            for pdf in pdfs:
                node = pdf["__node"].to_numpy()
                values = pdf[DIMS].to_numpy()
                dim = np.array([plan[n][0] for n in node], dtype=np.int64)
                v = values[np.arange(len(node)), dim] if len(node) else np.zeros(0, dtype=np.int64)
                c, i, w = (pdf[x].to_numpy() for x in ("__crc", "__id", "__size"))
                out = []
                for n in np.unique(node):
                    at = np.flatnonzero(node == n)
                    if n in bounds:
                        low, high = bounds[n]
                        under = before(v[at], c[at], i[at], low) if low else np.zeros(len(at), dtype=bool)
                        if under.any():
                            # All rows up to the lower bound count as one point there.
                            out.append(pd.DataFrame({"node": [n], "v": [low[0]], "c": [low[1]], "i": [low[2]], "w": [w[at][under].sum()]}))
                        at = at[~under & (before(v[at], c[at], i[at], high))]
                    out.append(_summary(node[at], v[at], c[at], i[at], w[at]))
                yield pd.concat(out)[["node", "v", "c", "i", "w"]].astype("int64") if out else pd.DataFrame(columns=["node", "v", "c", "i", "w"], dtype="int64")

        def merge(pdf):
            # Points at one place are one point, so the rows below a bound stay apart from those above it.
            pdf = pdf.groupby(["node", "v", "c", "i"], as_index=False)["w"].sum()
            out = []
            for n, g in pdf.groupby("node"):
                low = bounds.get(n, (None,))[0]
                under = (g[["v", "c", "i"]] == low).all(axis=1).to_numpy() if low else np.zeros(len(g), dtype=bool)
                out += [g[under], _summary(*(g[~under][x].to_numpy() for x in ("node", "v", "c", "i", "w")))]
            return pd.concat(out)[["node", "v", "c", "i", "w"]].astype("int64")

        points = (rows.select(*cols).withColumn("__part", F.spark_partition_id() % parts)
                      .select("__part", *cols).mapInPandas(_per_part(local), "part int, " + SUMMARY))
        if parts > 1:
            points = points.groupBy("part").applyInPandas(lambda pdf: merge(pdf.drop(columns="part")), SUMMARY)
        got = points.select("node", "v", "c", "i", "w").toPandas()
        for n, g in got.groupby("node"):
            g = g.groupby(["v", "c", "i"], as_index=False)["w"].sum().sort_values(["v", "c", "i"])
            keys = list(g[["v", "c", "i"]].itertuples(index=False, name=None))
            total, target = np.cumsum(g["w"].to_numpy()), plan[n][1]
            if last:
                k = int(np.argmin(np.abs(total - target)))
                cuts[n] = tuple(int(x) for x in keys[k])
            else:
                slack = 2 * total[-1] / SLICES
                under = np.flatnonzero(total + slack <= target)
                over = np.flatnonzero(total >= target)
                bounds[n] = (tuple(int(x) for x in keys[under[-1]]) if len(under) else None,
                             tuple(int(x) for x in keys[over[0] if len(over) else -1]))
    return cuts


def _per_part(local):
    def run(pdfs):
        for pdf in pdfs:
            if len(pdf):
                for out in local([pdf]):
                    out.insert(0, "part", np.int32(pdf["__part"].iloc[0]))
                    yield out
    return run


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
              text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """``docs`` with size, text_crc32, shard and slot; as many shards as asked for, or as hold ``target_bytes`` each."""
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.drop("size", "text_crc32", "shard", "slot")
    meta = docs.select(*[c.alias(n) for n, c in coordinates(docs, id_col, text, source, lang).items()]).checkpoint()
    n, weight = meta.agg(F.count(F.lit(1)), F.coalesce(F.sum("__size"), F.lit(0))).first()
    if shards is None:
        shards = max(1, round(weight / target_bytes))
    few = max(docs.sparkSession.sparkContext.defaultParallelism, -(-n // 1_000_000))
    tree, top = build_tree(meta.coalesce(few), shards)

    parts = max(16, -(-n // (shards * PART_ROWS)))
    part = F.pmod(F.xxhash64("__id", "__crc"), F.lit(parts))
    counts = _routed(meta, tree, top).groupBy(F.col("__node").alias("shard"), part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    below = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(below), F.lit(0)).alias("__below"))
    placed = _routed(docs.withColumns(coordinates(docs, id_col, text, source, lang)), tree, top)
    placed = placed.withColumnRenamed("__node", "shard").withColumn("__part", part)
    inside = Window.partitionBy("shard", "__part").orderBy("__id", "__crc", "__size")
    out = placed.withColumn("__rn", F.row_number().over(inside)).join(offsets, ["shard", "__part"])
    return out.select(*docs.columns, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                      F.col("shard").cast("int").alias("shard"), (F.col("__below") + F.col("__rn") - 1).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order within each file."""
    parts = F.floor(F.col("slot") / PART_ROWS)
    sharded.repartition("shard", parts).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_kd_shards(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = kd_shards(docs, shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
