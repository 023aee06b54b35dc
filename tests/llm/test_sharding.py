import zlib
from collections import defaultdict

from common import corpus, frame

from strata.llm.sharding import kd_shards, write_shards


def test_shards_cover_all_rows_with_near_equal_bytes(spark):
    rows = [(i, t) for i, t in corpus(n=400) if i != 306]
    out = kd_shards(frame(spark, rows, shard="clash", slot=1), shards=7).collect()
    assert sorted(str((r.doc_id, r.text)) for r in out) == sorted(str(r) for r in rows)
    load, slots = defaultdict(int), defaultdict(list)
    for r in out:
        data = (r.text or "").encode()
        assert r["size"] == len(data) + 16 and r.text_crc32 == zlib.crc32(data)
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    largest = max(r["size"] for r in out)
    assert set(load) == set(range(7))
    # Each cut is off by one row at most on either side, and a shard lies below three cuts.
    assert max(load.values()) - min(load.values()) <= 6 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_hot_group_of_copies_is_cut(spark):
    rows = [(k, "the same text " * 5) for k in range(300)] + [(1000 + k, f"other {k} " * 8) for k in range(150)]
    out = kd_shards(frame(spark, rows, parts=5), shards=8).groupBy("shard").sum("size").collect()
    loads = [r[1] for r in out]
    assert len(loads) == 8 and max(loads) < 1.1 * min(loads)


def test_target_bytes_repeated_rows_and_few_rows(spark, tmp_path):
    rows = corpus(n=50)
    out = kd_shards(frame(spark, rows), target_bytes=20_000)
    assert out.select("shard").distinct().count() > 3
    write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    assert kd_shards(frame(spark, rows[:2]), shards=5).count() == 2
    same = kd_shards(frame(spark, [(1, "x")] * 9), shards=4).collect()
    assert len(same) == 9 and len({r.shard for r in same}) == 1
    assert sorted(r.slot for r in same) == list(range(9))
    assert kd_shards(frame(spark, rows[:1]).limit(0), shards=3).count() == 0
