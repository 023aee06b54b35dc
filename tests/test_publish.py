"""Publication: all or nothing, as of a time, expiry."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import ConstraintViolation, constraint_report
from strata.sources.publish import NotPublished, Publication


def keys(t):
    return constraint_report({"dim.id": (t["dim"], ["id"])}, {"fact.id": (t["fact"], "id", t["dim"], "id")})


def test_publish_refuse_read_expire(spark, tmp_path):
    pub = Publication(spark, str(tmp_path / "pub"))
    with pytest.raises(NotPublished):
        pub.read("dim")
    dim, fact = spark.range(5), spark.range(20).select((F.col("id") % 5).alias("id"), F.lit(1).alias("v"))
    first = pub.publish({"dim": dim, "fact": fact}, keys)
    bad = fact.union(spark.createDataFrame([(99, 1)], "id long, v int"))
    with pytest.raises(ConstraintViolation, match="fact.id=1"):
        pub.publish({"dim": dim, "fact": bad}, keys, run_id="refused")
    assert pub.read("fact").count() == 20 and [r["run_id"] for r in pub.runs()] == [first]
    at = pub.runs()[0]["published_at"]
    second = pub.publish({"dim": dim, "fact": fact.where("id < 4")}, keys)
    assert pub.read("fact").count() == 16 and pub.read("fact", as_of=at).count() == 20
    with pytest.raises(NotPublished):
        pub.read("fact", as_of="2000-01-01")
    assert (tmp_path / "pub" / "current_run").read_text() == second
    assert pub.expire(keep=1) == sorted([first, "refused"])
    assert os.listdir(tmp_path / "pub" / "runs") == [second] and [r["run_id"] for r in pub.runs()] == [second]
    assert pub.read("fact").count() == 16
    with pytest.raises(ValueError):
        pub.expire(0)
