"""The pipeline's stages on small tables, each against its operator's brute force, and the registered names."""

import os
import random

from common import frame, prose

import __spark_entry__ as E
import corpus_pipeline as C

BAD = ["grumbol", "snarkly", "vexorat"]


def write_tables(spark, root):
    rng = random.Random(21)
    items = [(k, prose(rng, 30)) for k in range(6)]
    rows, labels = [], []
    for k in range(300):
        text = "\n".join(prose(rng, rng.randint(15, 50)) for _ in range(3))
        bad = k % 6 == 0
        if bad:
            text += f" {rng.choice(BAD)} {rng.choice(BAD)}"
        rows.append((k, text))
        labels.append((k, 1, int(bad)))
    # The same words in other lines: no line occurs twice, but the two are near-duplicates.
    near = prose(rng, 240).split(" ")
    broken = lambda n: "\n".join(" ".join(near[k:k + n]) for k in range(0, 240, n))
    rows += [(1000, broken(40)), (1001, broken(60) + " other"), (1002, rows[2][1]), (1003, items[0][1]), (1004, None), (1005, "")]
    frame(spark, rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    root = str(tmp_path)
    write_tables(spark, root)
    docs, ids = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in C.STAGES:
        out = stage(spark, docs, root)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        ids.append({r.doc_id for r in docs.collect()})
    toxic, lines, near, clean, packed = ids
    assert len([k for k in range(0, 300, 6) if k in toxic]) <= 2 and len(toxic) >= 245
    assert 1002 in toxic and 1002 not in lines and toxic - lines == {1002}
    assert lines - near == {1001}
    assert near - clean == {1003} and packed == clean and {1004, 1005} <= packed


def test_run_equals_the_stages(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    out = C.run(spark, str(tmp_path))
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_registered():
    names = E.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert os.path.exists(C.__file__)


def test_near_dedup_from_similarity_80(spark):
    words = prose(random.Random(31), 104).split(" ")
    grams = lambda w: {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    edited = [*words[:50], "Edited", *words[51:85], "Changed", *words[86:]]
    a, b = grams(words), grams(edited)
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    other = prose(random.Random(32), 104)
    docs = frame(spark, [(1, " ".join(words)), (2, " ".join(edited)), (3, other)])
    assert sorted(r.doc_id for r in C.near_dedup(spark, docs, "").collect()) == [1, 3]
