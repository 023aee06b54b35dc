"""Incremental landing: only new raw files are copied on each run."""

import os

from fixtures import write_csv
from strata.streaming import land_new_files


def test_only_new_files_are_landed(spark, tmp_path):
    raw = tmp_path / "raw"
    write_csv(str(raw / "kaggle" / "a.csv"), ["x"], [[1], [2]])
    write_csv(str(raw / "soccerdata" / "b.csv"), ["y"], [[3]])
    bronze, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    first = sorted(r.key for r in land_new_files(spark, str(raw), bronze, ckpt, "2026-06-01").collect())
    assert first == ["raw_kaggle/ingest_date=2026-06-01/a.csv", "raw_soccerdata/ingest_date=2026-06-01/b.csv"]
    assert open(os.path.join(bronze, first[0])).read() == open(raw / "kaggle" / "a.csv").read()
    assert land_new_files(spark, str(raw), bronze, ckpt, "2026-06-02").count() == 0
    write_csv(str(raw / "kaggle" / "c.csv"), ["z"], [[4]])
    third = [r.key for r in land_new_files(spark, str(raw), bronze, ckpt, "2026-06-03").collect()]
    assert third == ["raw_kaggle/ingest_date=2026-06-03/c.csv"]
