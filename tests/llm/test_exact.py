"""The digest index against brute force, batch after batch."""

import hashlib
import re

import duckdb
import pytest
from common import corpus, frame

from strata.llm.exact import OP13_SQL, DigestIndex, digest_rows, new_documents, op13_digest_index


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """(id, keep_id, size, sha256) of each row, sorted, and the number of rows kept."""
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(i), str(keep[plain(t)]), len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in rows), len(groups)


def results(df):
    return sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in df.collect())


ODD = [(400, "a  b"), (401, "a\t\nb"), (402, "a b "), (403, "a b"), (404, " "), (405, "\r\n"), (406, "a b"), (407, "é " * 40_000), (408, "é\n" * 40_000)]


def test_index_matches_brute_force(spark, tmp_path):
    rows = corpus() + ODD + [(None, "no id"), (None, "no id"), (None, "one two")]
    index = DigestIndex(spark, f"{tmp_path}/it's an index", 4)
    got = digest_rows(frame(spark, rows), carry=["doc_id"])
    index.ingest(got)
    out = index.resolve(got).cache()
    want, groups = brute(rows)
    assert results(out) == want
    kept = out.where("kept")
    # One row of each group, of repeated rows too.
    assert kept.count() == groups == kept.select("text_sha256").distinct().count() == index.entries().count()
    assert kept.where("not (doc_id <=> keep_id)").count() == 0


def test_batches_replay_and_reopening(spark, tmp_path):
    path = f"{tmp_path}/index"
    first = [(1, "one"), (2, "two"), (3, "two"), (None, "x")]
    second = [(5, "one"), (6, "three"), (0, "two"), (7, "three"), (8, "x"), (9, None), (9, None)]
    index = DigestIndex(spark, path, 3)
    ids = lambda rows, index: sorted((str(r["doc_id"]), r["text"]) for r in new_documents(frame(spark, rows), index).collect())
    assert ids(first, index) == [("1", "one"), ("2", "two"), ("None", "x")]
    assert ids(second, index) == [("6", "three"), ("9", None)]
    # The same batch again adds nothing and gives the same documents.
    spark.sql(f"DROP TABLE {index.table}")
    again = DigestIndex(spark, path)
    assert again.buckets == 3 and again.entries().count() == 5
    assert ids(second, again) == [("6", "three"), ("9", None)]
    assert again.entries().count() == 5


def test_index_side_is_not_shuffled(spark, tmp_path):
    index = DigestIndex(spark, f"{tmp_path}/index", 8)
    rows = digest_rows(frame(spark, corpus()), carry=["doc_id"])
    index.ingest(rows)
    plan = rows.select("__digest").distinct().join(index.entries().hint("merge"), rows["__digest"] == index.entries()["digest"], "left_anti") \
               ._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("Scan parquet"):] if "Scan parquet" in plan else plan[plan.index("FileScan parquet"):]
    assert "Bucketed: true" in scan and "SortMergeJoin" in plan
    assert plan[: plan.index("FileScan parquet")].rsplit("SortMergeJoin", 1)[1].count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("bound", [1, 100])
def test_hot_groups(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr("strata.llm.exact.HEAVY_ROWS", bound)
    rows = [(k, "hot") for k in range(300)] + [(300 + k, f"text {k % 150}") for k in range(300)]
    index = DigestIndex(spark, f"{tmp_path}/index", 2)
    got = digest_rows(frame(spark, rows), carry=["doc_id"])
    index.ingest(got)
    assert results(index.resolve(got)) == brute(rows)[0]


def test_empty_table_and_clashing_columns(spark, tmp_path):
    index = DigestIndex(spark, f"{tmp_path}/index")
    docs = frame(spark, [(1, "a"), (2, "a")], kept="mine", keep_id=7, group_size="g", text_sha256="t", digest="d")
    assert new_documents(docs.limit(0), index).count() == 0
    out = new_documents(docs, index)
    assert out.columns == docs.columns
    assert [r["kept"] for r in out.collect()] == ["mine"]
    rows = digest_rows(docs)
    assert index.resolve(rows).where("kept").count() == 1


def test_query_equals_sql(spark, sf01):
    out = op13_digest_index(spark, sf01)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf01}/documents.parquet'")
    want = con.sql(OP13_SQL)
    assert {tuple(r) for r in out.select(*want.columns).collect()} == set(want.fetchall())
