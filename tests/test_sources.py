"""Discovery, landing, CSV scans, partitions and sinks."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fixtures import make_raw_tree
from strata.sources import bronze
from strata.sources.bronze import store_uri
from strata.sources.csv import multiheader_names, read_multiheader_csv, read_raw_csv, write_multiheader_csv
from strata.sources.records import read_csv_files as read_snapshots
from strata.sources.partitions import NoPartitionFound, read_latest
from strata.sources.sinks import audited_writes, manifest, write_partitioned, write_pointer


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return make_raw_tree(str(tmp_path_factory.mktemp("raw")))


def test_discover_lists_csv_files_only(spark, raw, tmp_path):
    (tmp_path / "x.txt").write_text("no")
    files = bronze.discover(spark, raw).collect()
    rel = sorted(r.relpath for r in files)
    assert "kaggle/matches_1930_2022.csv" in rel and "notes.csv" in rel
    assert all(r.size_bytes > 0 for r in files)
    with pytest.raises(bronze.NoRawFiles):
        bronze.discover(spark, str(tmp_path), "*.csv")


def test_land_copies_bytes_and_is_idempotent(spark, raw, tmp_path):
    dest = str(tmp_path / "bronze")
    ups = {r.key: r for r in bronze.land(spark, raw, dest, "2026-06-01").collect()}
    key = "raw_kaggle/ingest_date=2026-06-01/matches_1930_2022.csv"
    assert key in ups and "raw_divers/ingest_date=2026-06-01/notes.csv" in ups
    src = open(os.path.join(raw, "kaggle", "matches_1930_2022.csv"), "rb").read()
    assert open(os.path.join(dest, key), "rb").read() == src
    assert ups[key].size_bytes == len(src)
    again = bronze.land(spark, raw, dest, "2026-06-01").count()
    assert again == len(ups)


def test_read_raw_csv_nulls_tokens(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\nNA,1\nx,\nnull,N/A\n")
    rows = read_raw_csv(spark, str(p)).collect()
    assert [(r.a, r.b) for r in rows] == [(None, "1"), ("x", None), (None, None)]


def test_snapshots_union_by_name(spark, raw):
    paths = [os.path.join(raw, "kaggle", f) for f in sorted(os.listdir(os.path.join(raw, "kaggle")))
             if f.startswith("fifa_ranking_")]
    df = read_snapshots(spark, paths)
    assert "source_file" in df.columns and "team" in df.columns
    assert df.select("source_file").distinct().count() == len(paths)


def test_multiheader_names_rule():
    rows = [["", "", "", "players_used", "Performance", "Performance", "url"],
            ["", "", "", "", "Gls", "G+A", ""],
            ["league", "season", "team", "", "", "", ""]]
    assert multiheader_names(rows, 3) == ["league", "season", "team", "players_used", "performance_gls",
                                          "performance_g_plus_a", "url"]


def test_multiheader_reader_types_and_rows(spark, raw):
    df = read_multiheader_csv(spark, os.path.join(raw, "soccerdata", "player_stats.csv"), 4)
    assert df.columns[:4] == ["league", "season", "team", "player"]
    types = dict(df.dtypes)
    assert types["season"] == "bigint" and types["playing_time_min"] == "double" and types["player"] == "string"
    types = dict(read_multiheader_csv(spark, os.path.join(raw, "soccerdata", "player_stats.csv"), 4, text=None).dtypes)
    assert types["season"] == "bigint" and types["playing_time_min"] == "bigint"
    assert types["per_90_minutes_gls"] == "double" and types["nation"] == "string"
    assert df.count() == 8


def test_dynamic_overwrite_keeps_other_dates_and_latest(spark, tmp_path):
    root = str(tmp_path / "t")
    write_partitioned(spark.range(3), root, "2026-01-01")
    write_partitioned(spark.range(5), root, "2026-01-02")
    write_partitioned(spark.range(4), root, "2026-01-02")  # rerun replaces that date only
    assert read_latest(spark, root).count() == 4
    assert read_latest(spark, root, as_of="2026-01-01").count() == 3
    plan = read_latest(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingest_date" in plan
    with pytest.raises(NoPartitionFound):
        read_latest(spark, root, as_of="2025-01-01")


def test_audit_counts_rows_during_write(spark, tmp_path):
    audit = audited_writes(spark, {"a": spark.range(7), "b": spark.range(2)}, str(tmp_path), "2026-01-01")
    assert {r.table_name: r.n_rows for r in audit.collect()} == {"a": 7, "b": 2}
    m = manifest(audit).first()
    assert (m.table_count, m.total_rows) == (2, 9)


def test_observation_on_write(spark, tmp_path):
    obs = Observation("o")
    write_partitioned(spark.range(11), str(tmp_path / "x"), "2026-01-01", obs)
    assert obs.get["rows"] == 11


def test_country_payload(spark, tmp_path):
    p = tmp_path / "countries.json"
    p.write_text('[{"page":1},[{"id":"FRA","iso2Code":"FR","name":"France",'
                 '"region":{"id":"ECS","iso2code":"Z7","value":"Europe"},"capitalCity":"Paris"}]]')
    rows = bronze.read_country_payload(spark, str(p)).collect()
    assert rows[0].name == "France" and rows[0].region.value == "Europe"
    bad = tmp_path / "bad.json"
    bad.write_text('[{"page":1},[]]')
    with pytest.raises(ValueError):
        bronze.read_country_payload(spark, str(bad))


def test_nested_json_document(spark, tmp_path):
    p = tmp_path / "wc.json"
    p.write_text('{"tournaments":[{"year":2018,"host":"Russia"},{"year":2022,"host":"Qatar"}]}')
    df = bronze.read_json_document(spark, str(p)).select(F.explode("tournaments").alias("t")).select("t.*")
    assert sorted(r.year for r in df.collect()) == [2018, 2022]


def test_torn_and_long_rows_are_errors(spark, tmp_path):
    (tmp_path / "torn.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "long.csv").write_text("a,b\n1,2,3\n")
    (tmp_path / "short.csv").write_text('a,b\n1\n"2,2",z\n')
    for name in ("torn.csv", "long.csv"):
        with pytest.raises(Exception, match="too many cells or an open quote"):
            read_raw_csv(spark, str(tmp_path / name)).collect()
    assert read_raw_csv(spark, str(tmp_path / "torn.csv"), multiline=True).collect() == [("1", "x\ny")]
    assert sorted(read_raw_csv(spark, str(tmp_path / "short.csv")).collect()) == [("1", None), ("2,2", "z")]


def test_newest_partition_has_its_own_schema(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.sql("SELECT 1L AS age").write.parquet(f"{root}/ingest_date=2026-01-01")
    spark.sql("SELECT 2.5D AS age, 'x' AS extra").write.parquet(f"{root}/ingest_date=2026-01-02")
    new = read_latest(spark, root)
    assert [(r.age, r.extra, str(r.ingest_date)) for r in new.collect()] == [(2.5, "x", "2026-01-02")]
    assert read_latest(spark, root, as_of="2026-01-01").first().age == 1
    with pytest.raises(NoPartitionFound):
        read_latest(spark, root + "-absent")


def test_multiheader_writer_quotes_cells(spark, tmp_path):
    df = spark.createDataFrame([("L", 2020, 'A, "B"', 3.0), ("L", 2021, "C", None)], "league string, season int, team string, goals double")
    write_multiheader_csv(df, str(tmp_path / "m"), [("Goals", "")], ["league", "season", "team"], n_files=2)
    got = sorted(tuple(r) for r in read_multiheader_csv(spark, str(tmp_path / "m"), 3).select("season", "team", "goals").collect())
    assert got == [(2020, 'A, "B"', 3.0), (2021, "C", None)]


def test_pointer_is_replaced(spark, tmp_path):
    path = str(tmp_path / "current_run")
    for text in ("one", "two"):
        write_pointer(spark, path, text)
        assert spark.read.text(path).first()[0] == text
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["current_run"]


def test_store_scheme():
    assert store_uri("s3a://b/k") == "s3://b/k" and store_uri("/x") == "/x" and store_uri("hdfs://h/x") == "hdfs://h/x"


def test_country_payload_over_several_lines(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"page": 1},\n [{"id": "FRA",\n   "name": "France"},\n  {"id": "BRA", "name": "Brazil"}]]')
    assert sorted(r.id for r in bronze.read_country_payload(spark, str(tmp_path / "c.json")).collect()) == ["BRA", "FRA"]
