"""The Merkle manifest against trees built in memory."""

import hashlib
import random

import duckdb
import pytest
from common import SCHEMA, corpus, frame

from pyspark.sql import functions as F
from strata.llm import merkle
from strata.llm.merkle import LEAF_FIELDS, OP12_SQL, folded, levels_left, manifest, op12_merkle_manifest, proof_hash

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k: k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def steps(levels, k, fanout):
    for level in levels[:-1]:
        lo = k - k % fanout
        yield "".join(level[lo:k]), "".join(level[k + 1: lo + fanout])
        k //= fanout


def brute(rows, fanout=2):
    """rows: doc_id, source, lang, n_chars, text."""
    by = {}
    for r in rows:
        leaf = h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, r[0]))
    keys = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(by[k])], fanout) for k in keys}
    top = tree([trees[k][-1][0] for k in keys], fanout)
    out = []
    for n, key in enumerate(keys):
        for k, (_, _, leaf, i) in enumerate(sorted(by[key])):
            proof = [*steps(trees[key], k, fanout), *steps(top, n, fanout)]
            out.append((str(i), leaf, trees[key][-1][0], top[-1][0], h(*[a + b for a, b in proof]), top[-1][0]))
    return sorted(out)


def run(docs, fanout=2, epoch_levels=3):
    rows = manifest(docs, LEAF_FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id")}, fanout, epoch_levels)
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
                       folded(F.col("leaf"), F.col("proof")).alias("folded_root"))
    return sorted((str(r[0]), *r[1:]) for r in rows.collect())


def table(sizes, seed=3):
    rng, out = random.Random(seed), []
    for lang, n in sizes.items():
        out += [(len(out) + k, f"s{k % 3}", lang, k, f"text {rng.random()}") for k in range(n)]
    rng.shuffle(out)
    return out


def spread(spark, rows):
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    from pyspark.sql import types as T
    return spark.createDataFrame(rows, T.StructType([SCHEMA[c] for c in names])).repartition(3)


@pytest.mark.parametrize("fanout,epoch_levels", [(2, 3), (2, 12), (3, 2)])
def test_trees_of_all_sizes(spark, fanout, epoch_levels):
    rows = table({"one": 1, "two": 2, "three": 3, None: 5, "seven": 7, "": 16, "hot é": 77})
    assert run(spread(spark, rows), fanout, epoch_levels) == brute(rows, fanout)


def test_lone_tree_and_lone_leaf(spark):
    for sizes in ({"en": 13}, {"en": 1}):
        rows = table(sizes)
        assert run(spread(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [(i, "s", "en", None if t is None else len(t), t) for i, t in corpus(n=20)]
    rows += [(None, None, None, None, None), (None, None, None, None, ""), (5, "1:a", "-", 3, "-")]
    assert run(spread(spark, rows)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    docs = frame(spark, [(1, "a"), (2, "b")], leaf="mine", root="r", proof="p", subroot="s")
    assert run(docs.limit(0)) == []
    out = manifest(docs, LEAF_FIELDS, "lang", "doc_id", {c: F.col(c) for c in docs.columns})
    assert out.count() == 2 and out.where("leaf = 'mine'").count() == 0


def test_tampering_shows(spark):
    rows = table({"en": 40, "de": 9})
    out = manifest(spread(spark, rows), LEAF_FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id")}, 2, 3)
    assert out.where(folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 49
    assert out.where(folded(F.sha2(F.col("leaf"), 256), F.col("proof")) == F.col("root")).count() == 0
    # A proof leads to the root from its own leaf only.
    other = out.select(F.col("doc_id").alias("other"), F.col("leaf").alias("stray"))
    pairs = out.join(other, F.col("doc_id") + 1 == F.col("other"))
    assert pairs.where(folded(F.col("stray"), F.col("proof")) == F.col("root")).count() == 0


def test_levels():
    assert [levels_left(n) for n in (1, 2, 3, 4, 5, 8, 9)] == [0, 1, 2, 2, 3, 3, 4]
    assert levels_left(10, 3) == 3


@pytest.mark.parametrize("epoch_levels", [4, merkle.EPOCH_LEVELS])
def test_query_equals_sql(spark, sf01, monkeypatch, epoch_levels):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (2, epoch_levels))
    out = op12_merkle_manifest(spark, sf01)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf01}/documents.parquet'")
    want = con.sql(OP12_SQL)
    got = out.select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    assert 0 < sum(not r["verified"] for r in got) < len(got)
