"""Property checks: parsers against plain-Python statements of their rules,
and results that must not depend on the number of shuffle partitions."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata import functions as S

PY_WS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def py_minute(tok):
    m = re.fullmatch(r"([0-9]+)(?:\+([0-9]+))?", tok.strip(PY_WS))
    if not m:
        return (None, None, None)
    base, add = int(m.group(1)), int(m.group(2) or 0)
    return (base, add, base + add)


def py_score(text):
    nums = re.findall(r"[0-9]+", re.sub(r"\([0-9]+\)", "", text))
    return (int(nums[0]), int(nums[1])) if len(nums) >= 2 else (None, None)


def py_rsplit(text, sep):
    if sep not in text:
        return (text.strip(PY_WS), None)
    head, tail = text.rsplit(sep, 1)
    return (head.strip(PY_WS), tail.strip(PY_WS))


def py_long(text):
    """Integer text (one optional sign) or a whole float, within 64 bits; else None."""
    t = text.strip(PY_WS)
    if re.fullmatch(r"[+-]?[0-9]+", t):
        v = int(t)
    else:
        try:
            d = float(t)
        except ValueError:
            return None
        if d != d or d in (float("inf"), float("-inf")) or d != int(d):
            return None
        v = int(d)
    return v if -2**63 <= v < 2**63 else None


tokens = st.text(alphabet="0123456789+ ()–-,. \t ax", max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tokens, min_size=1, max_size=40))
def test_parsers_agree_with_python_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    hs, as_ = S.split_score("v")
    head, tail = S.rsplit_last("v", ",")
    m = S.parse_minute("v")
    rows = df.select("v", m.alias("m"), hs.alias("hs"), as_.alias("as_"),
                     head.alias("h"), tail.alias("t")).collect()
    for r in rows:
        assert (r.m.minute, r.m.stoppage_time, r.m.minute_absolute) == py_minute(r.v), r.v
        assert (r.hs, r.as_) == py_score(r.v), r.v
        assert (r.h, r.t) == py_rsplit(r.v, ","), r.v


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789+-. e\t", max_size=8), min_size=1, max_size=40))
def test_to_long_agrees_with_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", S.to_long("v").alias("x")).collect():
        assert r.x == py_long(r.v), r.v


@pytest.mark.parametrize("name", ["team_record", "scorer_rank", "surrogate_key", "dim_antijoin",
                                  "edition_stats", "fact_goal"])
def test_result_independent_of_shuffle_partitions(spark, name):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(sorted(tuple(r) for r in E.queries()[name](spark, sf).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
