"""Unit cases for the Column expressions."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from strata import functions as S


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("label,expected", [
    ("Per 90 Minutes_G+A", "per_90_minutes_g_plus_a"),
    ("G-PK", "g_pk"), ("SoT%", "sot_pct"), ("Sh/90", "sh_per_90"), ("  ", "col"), ("__x__", "x"),
])
def test_snake_name_and_column_agree(spark, label, expected):
    assert S.snake_name(label) == expected
    assert one(spark, S.snake_case("v"), label) == expected


@pytest.mark.parametrize("raw,expected", [
    ("  Korea \t Republic ", "South Korea"), ("IR Iran", "Iran"), ("Korea DPR", "North Korea"),
    ("France", "France"), (None, None), ("", ""),
])
def test_canonical_label(spark, raw, expected):
    from strata.plans.silver import TEAM_NAME_MAP
    assert one(spark, S.canonical_label("v", TEAM_NAME_MAP), raw) == expected


def test_canonicalize_with_table(spark):
    df = spark.createDataFrame([(" USA ",), ("Peru",)], "team string")
    m = spark.createDataFrame([("USA", "United States")], "label string, canonical string")
    out = sorted(r.team for r in S.canonicalize_with_table(df, "team", m).collect())
    assert out == ["Peru", "United States"]


def test_row_key_matches_python_md5(spark):
    df = spark.createDataFrame([(dt.date(2018, 6, 14), "Russia", None)], "d date, h string, a string")
    got = df.select(S.row_key("d", "h", "a").alias("k")).first().k
    assert got == hashlib.md5(b"2018-06-14|Russia|None").hexdigest()[:12]


@pytest.mark.parametrize("raw,expected", [
    ("2022-12-18", dt.date(2022, 12, 18)), ("18/12/2022", None), ("2022-02-30", None), (None, None),
])
def test_to_date_coerce(spark, raw, expected):
    assert one(spark, S.to_date_coerce("v"), raw) == expected


@pytest.mark.parametrize("raw,expected", [("9:00", "09:00"), ("13:00", "13:00"), ("25:00", None),
                                          ("abc", None), (None, None)])
def test_norm_time(spark, raw, expected):
    assert one(spark, S.norm_time("v"), raw) == expected


@pytest.mark.parametrize("raw,local,other", [
    ("13:00 (22:00)", "13:00", "22:00"), ("17:00", "17:00", None), (" 9:30 (18:30)", "09:30", "18:30"),
    ("TBD", None, None), (None, None, None),
])
def test_parse_kickoff(spark, raw, local, other):
    a, b = S.parse_kickoff("v")
    r = spark.createDataFrame([(raw,)], "v string").select(a.alias("a"), b.alias("b")).first()
    assert (r.a, r.b) == (local, other)


def test_local_timestamp_null_when_time_missing(spark):
    df = spark.createDataFrame([("2026-06-11", "13:00"), ("2026-06-11", None)], "d string, t string")
    got = [r.x for r in df.select(S.local_timestamp("d", "t").alias("x")).collect()]
    assert got == [dt.datetime(2026, 6, 11, 13, 0), None]


@pytest.mark.parametrize("raw,expected", [
    ("3–1", (3, 1)), ("(4) 3–3 (2)", (3, 3)), ("2", (None, None)), (None, (None, None)),
])
def test_split_score(spark, raw, expected):
    a, b = S.split_score("v")
    r = spark.createDataFrame([(raw,)], "v string").select(a.alias("a"), b.alias("b")).first()
    assert (r.a, r.b) == expected


@pytest.mark.parametrize("raw,expected", [
    ("45", (45, 0, 45)), ("90+7", (90, 7, 97)), (" 108 ", (108, 0, 108)), ("xx", (None, None, None)),
    ("", (None, None, None)), ("45+", (None, None, None)),
])
def test_parse_minute(spark, raw, expected):
    r = one(spark, S.parse_minute("v"), raw)
    assert (r.minute, r.stoppage_time, r.minute_absolute) == expected


@pytest.mark.parametrize("base,expected", [(1, "1re mi-temps"), (45, "1re mi-temps"), (46, "2e mi-temps"),
                                           (90, "2e mi-temps"), (91, "prolongation"), (None, None)])
def test_period(spark, base, expected):
    assert one(spark, S.period_of_minute("v"), base, "v int") == expected


def test_parse_goal_cell(spark):
    r = one(spark, S.parse_goal_cell("v"), "Messi · 108|Di María · 36| |Mbappé (P) · 80|NoMinute")
    assert [(x.scorer, x.minute_token) for x in r] == [
        ("Messi", "108"), ("Di María", "36"), ("Mbappé", "80"), ("NoMinute", "")]
    assert one(spark, S.parse_goal_cell("v"), None) == []


@pytest.mark.parametrize("raw,expected", [("12", 12), ("64.0", 64), (" 7 ", 7), ("abc", None),
                                          ("1e3", 1000), (None, None), ("NaN", None),
                                          ("9007199254740993", 9007199254740993)])
def test_to_long(spark, raw, expected):
    assert one(spark, S.to_long("v"), raw) == expected


def test_to_long_fraction_lenient_and_strict(spark):
    assert one(spark, S.to_long("v"), "12.5") is None
    with pytest.raises(Exception):
        one(spark, S.to_long("v", strict=True), "12.5")


@pytest.mark.parametrize("raw,expected", [("1.5", 1.5), ("x", None), ("nan", None), (" 2 ", 2.0)])
def test_to_double(spark, raw, expected):
    assert one(spark, S.to_double("v"), raw) == expected


@pytest.mark.parametrize("raw,head,tail", [
    ("Kazan Arena, Kazan", "Kazan Arena", "Kazan"), ("A, B, C", "A, B", "C"), ("Maracanã", "Maracanã", None),
])
def test_rsplit_last(spark, raw, head, tail):
    h, t = S.rsplit_last("v", ",")
    r = spark.createDataFrame([(raw,)], "v string").select(h.alias("h"), t.alias("t")).first()
    assert (r.h, r.t) == (head, tail)


def test_flag_and_strip(spark):
    f, t = S.flag_and_strip("v")
    rows = spark.createDataFrame([("Arena Corinthians (Neutral Site)",), ("Lusail",), (None,)], "v string") \
        .select(f.alias("f"), t.alias("t")).collect()
    assert [(r.f, r.t) for r in rows] == [(True, "Arena Corinthians"), (False, "Lusail"), (False, None)]


@pytest.mark.parametrize("x,digits,expected", [(0.125, 2, 0.12), (1.005, 2, 1.0), (2.5, 0, 2.0),
                                               (3.5, 0, 4.0), (58.06, 1, 58.1)])
def test_round_half_even_like_numpy(spark, x, digits, expected):
    import numpy as np
    assert one(spark, S.round_half_even("v", digits), x, "v double") == expected == float(np.round(x, digits))


def test_indicator_and_sum_or_zero(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert [r.i for r in df.select(S.indicator(F.col("a") > F.col("b")).alias("i")).collect()] == [0, 0]
    assert df.agg(S.sum_or_zero("b").alias("s")).first().s == 0


def test_snapshot_date_from_name(spark):
    assert one(spark, S.snapshot_date_from_name("v"), "fifa_ranking_2026-06-08.csv") == dt.date(2026, 6, 8)
    assert one(spark, S.snapshot_date_from_name("v"), "ranking.csv") is None


@pytest.mark.parametrize("raw,number,whole", [
    ("12d", None, None), ("64f", None, None), ("0x1p3", None, None), ("12.5D", None, None), ("1_0", None, None), ("1e3", 1000.0, 1000),
    (" 12 ", 12.0, 12), ("-3.00", -3.0, -3), (".5", 0.5, None), ("+7", 7.0, 7), ("inf", float("inf"), None), ("-Infinity", float("-inf"), None),
    ("nan", None, None), ("", None, None), ("e", None, None), ("--1", None, None), ("1.2.3", None, None),
])
def test_only_plain_numbers_are_numbers(spark, raw, number, whole):
    assert one(spark, S.to_double("v"), raw) == number
    assert one(spark, S.to_long("v"), raw) == whole


@pytest.mark.parametrize("raw,expected", [
    ("2018-06-14", dt.date(2018, 6, 14)), ("2018-6-4", dt.date(2018, 6, 4)), ("2018-06-14 00:00:00", dt.date(2018, 6, 14)),
    ("2018-06-14T21:30", dt.date(2018, 6, 14)), ("2018", None), ("2018-06-14 later", None), ("2018-13-01", None), ("06-14-2018", None),
    ("2018--6-14", None), ("", None), (None, None),
])
def test_iso_dates_of_any_length(spark, raw, expected):
    assert one(spark, S.to_date_coerce("v"), raw) == expected


def test_date_and_kickoff_agree(spark):
    assert one(spark, S.local_timestamp(F.col("v"), F.lit("09:30")), "2018-6-4") == dt.datetime(2018, 6, 4, 9, 30)
    assert one(spark, S.local_timestamp(F.col("v"), F.lit("09:30")), "unknown") is None
