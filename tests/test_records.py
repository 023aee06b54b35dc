"""Records across splits, quoted newlines, many headers."""

import random

import pytest

from strata.sources.csv import read_raw_csv
from strata.sources.records import read_csv_files, read_records, split_lines


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n"):
    import csv
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


def cells(rng):
    pool = ["plain", "x,y", 'say "hi"', "two\nlines", "a\n\n\nb, \"c\"\n", "é", "", "1", "long " * 30, '"\n"']
    return rng.choice(pool)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_newlines_across_splits(spark, small_splits, tmp_path, end):
    rng = random.Random(3)
    rows = [[str(k), cells(rng), cells(rng)] for k in range(150)]
    write(tmp_path / "a.csv", [["id", "a", "b"], *rows], end)
    assert split_lines(spark, str(tmp_path)).select("split").distinct().count() > 20
    assert read_records(spark, str(tmp_path)).count() == 151
    got = {r.id: (r.a, r.b) for r in read_csv_files(spark, str(tmp_path)).collect()}
    assert got == {i: (a or None, b or None) for i, a, b in rows}
    whole = {r.id: (r.a, r.b) for r in read_raw_csv(spark, str(tmp_path), multiline=True).collect()}
    assert got == whole


def test_headers_that_differ_take_one_scan(spark, small_splits, tmp_path):
    want = []
    for k in range(12):
        names = random.Random(k).sample(["team", "rank", "points", "coach\nname"], 3) + ["day"]
        rows = [[f"{n}{k}-{j}" for n in names] for j in range(9)]
        write(tmp_path / f"snap_{k}.csv", [names, *rows])
        want += [{**dict(zip(names, r, strict=True)), "source_file": f"snap_{k}.csv"} for r in rows]
    df = read_csv_files(spark, str(tmp_path))
    assert set(df.columns) == {"team", "rank", "points", "coach\nname", "day", "source_file"}
    got = [{c: v for c, v in r.asDict().items() if v is not None} for r in df.collect()]
    key = lambda d: sorted(d.items())
    assert sorted(got, key=key) == sorted(want, key=key)
    scans = lambda paths: read_csv_files(spark, paths)._jdf.queryExecution().executedPlan().toString().count("FileScan text")
    assert scans(str(tmp_path)) == scans(str(tmp_path / "snap_0.csv"))


def test_torn_records_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="too many cells"):
        read_csv_files(spark, str(tmp_path / "a.csv")).collect()
    (tmp_path / "b.csv").write_text('a,b\n1,"2\n3,4\n')
    with pytest.raises(Exception, match="open quote"):
        read_csv_files(spark, str(tmp_path / "b.csv")).collect()
    (tmp_path / "c.csv").write_text("a,b\n\n1\n2,NA\n")
    assert sorted(map(tuple, read_csv_files(spark, str(tmp_path / "c.csv")).collect())) == [("1", None, "c.csv"), ("2", None, "c.csv")]
