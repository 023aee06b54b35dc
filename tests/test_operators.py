"""Operator properties: dense keys, first/last, unions, joins, key checks."""

import pytest
from pyspark.sql import functions as F

from strata.operators import (append_missing, assert_constraints, ConstraintViolation, constraint_report,
                              dense_surrogate, fits_broadcast, fk_orphans, keep_first, latest_non_null,
                              pk_violations, role_union, sequential_rank, stack_columns, unpivot_tagged)


@pytest.mark.parametrize("part_rows", [300, 100_000])
def test_dense_surrogate_is_dense_and_ordered(spark, part_rows):
    df = spark.range(0, 5000).select(F.md5(F.col("id").cast("string")).alias("h"), "id").repartition(7)
    out = dense_surrogate(df, ["h"], "k", part_rows=part_rows).collect()
    ks = sorted(r.k for r in out)
    assert ks == list(range(1, 5001))
    by_k = [r.h for r in sorted(out, key=lambda r: r.k)]
    assert by_k == sorted(by_k)


@pytest.mark.parametrize("parts", ["1", "3", "16"])
def test_dense_surrogate_independent_of_shuffle_partitions(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(0, 2000).select((F.col("id") % 37).alias("g"), "id")
        got = {(r.g, r.id): r.k for r in dense_surrogate(df, ["g", "id"], "k", part_rows=100).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    expected = {key: i + 1 for i, key in enumerate(sorted(got))}
    assert got == expected


def test_dense_surrogate_with_hot_leading_value(spark):
    # a third of the rows share the leading key; the full key keeps them splittable
    df = spark.range(0, 3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("g"), "id")
    got = sorted((r.g, r.id, r.k) for r in dense_surrogate(df, ["g", "id"], "k", part_rows=100).collect())
    assert [k for _, _, k in got] == list(range(1, 3001))


@pytest.mark.parametrize("part_rows", [1, 10])
def test_sequential_rank_breaks_ties_by_id(spark, part_rows):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 5), (4, 9)], "id int, n int")
    got = {r.id: r.rang for r in sequential_rank(df, "n", ["id"], "rang", part_rows).collect()}
    assert got == {4: 1, 2: 2, 1: 3, 3: 4}


@pytest.mark.parametrize("part_rows", [1, 10])
def test_nulls_sort_last(spark, part_rows):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    got = {r.x: r.k for r in dense_surrogate(df, ["x"], "k", part_rows=part_rows).collect()}
    assert got == {"a": 1, "b": 2, None: 3}


def test_keep_first_uses_declared_order(spark):
    df = spark.createDataFrame([("v", "c1", 3), ("v", "c2", 1), ("w", "c3", 2)], "name string, city string, o int")
    got = {r.name: r.city for r in keep_first(df, ["name"], ["o"]).collect()}
    assert got == {"v": "c2", "w": "c3"}


def test_latest_non_null_per_column(spark):
    df = spark.createDataFrame([("FRA", "UEFA", "FRA", 1), ("FRA", None, "FR", 2), ("BRA", "CONMEBOL", None, 1)],
                               "team string, conf string, code string, snap int")
    got = {r.team: (r.conf, r.code) for r in latest_non_null(df, ["team"], ["conf", "code"], ["snap"]).collect()}
    assert got == {"FRA": ("UEFA", "FR"), "BRA": ("CONMEBOL", None)}


def test_role_union_single_scan(spark):
    df = spark.createDataFrame([(1, 2, 3, 0)], "h int, a int, hs int, as_ int")
    out = role_union(df, [{"t": "h", "f": "hs", "c": "as_"}, {"t": "a", "f": "as_", "c": "hs"}])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 3, 0), (2, 0, 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1


def test_stack_columns_and_unpivot(spark):
    df = spark.createDataFrame([("a", "b", None)], "x string, y string, z string")
    assert sorted(r.v for r in stack_columns([(df, ["x", "y", "z"])], "v").collect() if r.v) == ["a", "b"]
    long = unpivot_tagged(df, [("x", {"side": "home"}), ("missing", {"side": "n"}), ("y", {"side": "away"})],
                          "cell", [])
    assert sorted((r.source_ordinal, r.side, r.cell) for r in long.collect()) == [(0, "home", "a"), (2, "away", "b")]


def test_append_missing(spark):
    known = spark.createDataFrame([("a", "FW")], "nom string, poste string")
    cand = spark.createDataFrame([("a",), ("b",), ("b",)], "nom string")
    assert sorted(tuple(r) for r in append_missing(known, cand, "nom").collect()) == [("a", "FW"), ("b", None)]


def test_key_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "fk int")
    assert [r.fk for r in fk_orphans(child, "fk", parent, "id").collect()] == [3]
    dup = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert sorted((r.id is None, r.n_rows) for r in pk_violations(dup, ["id"]).collect()) == [(False, 2), (True, 1)]
    ok = constraint_report({"p.id": (parent, ["id"])}, {})
    assert assert_constraints(ok)[0]["violations"] == 0
    with pytest.raises(ConstraintViolation):
        assert_constraints(constraint_report({}, {"c.fk": (child, "fk", parent, "id")}))


def test_fits_broadcast(spark):
    assert fits_broadcast(spark.range(10), 10)
    assert not fits_broadcast(spark.range(11), 10)


def test_distributed_path_plan_has_no_single_partition_sort(spark):
    df = spark.range(0, 3000).select(F.md5(F.col("id").cast("string")).alias("h"))
    out = dense_surrogate(df, ["h"], "k", part_rows=200)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in p and "SinglePartition" not in p and "rangepartitioning" not in p
    assert sorted(r.k for r in out.collect()) == list(range(1, 3001))


KINDS = {
    "long": [None, 0, 1, -1, 2 ** 62, 2 ** 62 + 1, -2 ** 63, 2 ** 63 - 1, 5, 6],
    "double": [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-320, 2e-320, 1e308, -1e308, 1.5, 1.25],
    "string": [None, "", "a", "a\0", "ab", "Customer#000000001", "Customer#000000002", "Customer#0000000010", "é", "\U0001f600", "z" * 40, "z" * 41],
    "date": [None, "1969-12-31", "1970-01-01", "2024-02-29", "0001-01-01"],
    "timestamp_ntz": [None, "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-02-29 12:00:00.000001", "2024-02-29 12:00:00.000002"],
    "boolean": [None, True, False],
    "decimal(20,3)": [None, "1.001", "1.002", "-5", "99999999999999999.999"],
}


@pytest.mark.parametrize("kind,down", [("long", True), ("double", False), ("double", True), ("string", False), ("timestamp_ntz", True), ("decimal(20,3)", False)])
def test_dense_keys_equal_one_global_window(spark, kind, down):
    """Hot values, ties, nulls and odd values of each type, against row_number() over everything."""
    from pyspark.sql import Window
    from strata.operators.surrogate import _sort_column, descending
    values = KINDS[kind]
    df = spark.createDataFrame([(k, None if v is None else str(v) if kind not in ("string",) else v)
                                for k, v in enumerate(values)], "n int, x string")
    df = df.select(F.col("x").cast(kind).alias("x"), "n").crossJoin(spark.range(30).toDF("m")).where("n = 2 or m < 3").coalesce(2).withColumn("y", F.col("m") % 3)
    key = descending("x") if down else "x"
    got = dense_surrogate(df, [key, "y"], "k", part_rows=9).collect()
    full = [_sort_column(key), *[F.col(c).asc_nulls_last() for c in ("y", "n", "m")]]
    # Rows of the same x and y are told apart by the other columns, in the table's order.
    want = df.withColumn("k", F.row_number().over(Window.orderBy(*full))).collect()
    show = lambda rows: sorted((r.k, str(r.x), r.y, r.n, r.m) for r in rows)
    assert show(got) == show(want)


def test_dense_keys_of_identical_rows_and_many_digits(spark):
    same = spark.range(0, 700).select(F.lit("one and the same text, rather long").alias("s"))
    assert sorted(r.k for r in dense_surrogate(same, ["s"], "k", part_rows=50).collect()) == list(range(1, 701))
    texts = spark.range(0, 900).select(F.concat(F.lit("p" * 100), (F.col("id") % 300).cast("string")).alias("s"), "id")
    got = dense_surrogate(texts, ["s"], "k", part_rows=20).collect()
    assert [r.s for r in sorted(got, key=lambda r: r.k)] == sorted(r.s for r in got)
    assert got[0].k is not None and dict(dense_surrogate(texts, ["s"], "k").dtypes)["k"] == "bigint"
    assert dense_surrogate(texts.limit(0), ["s"], "k").count() == 0


def test_first_and_last_with_null_ordinals_and_ties(spark):
    rows = [("a", None, "undated"), ("a", 2, "later"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "only")]
    df = spark.createDataFrame(rows, "k string, d int, v string").repartition(4)
    assert {r.k: r.v for r in keep_first(df, ["k"], ["d"]).collect()} == {"a": "y", "b": "only"}
    assert {r.k: r.v for r in latest_non_null(df, ["k"], ["v"], ["d"]).collect()} == {"a": "undated", "b": "only"}
    dated = df.where("d is not null")
    tied = dated.union(spark.createDataFrame([("a", 2, "last")], dated.schema))
    assert latest_non_null(tied, ["k"], ["v"], ["d"]).first().v == "later"


def test_broadcast_is_bounded_by_bytes(spark, monkeypatch):
    from strata.operators import joins
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 1000)
    wide = spark.range(20).select(F.repeat(F.lit("x"), 100).alias("s"), "id")
    assert not fits_broadcast(wide, 50) and fits_broadcast(wide.select("id"), 50)


def test_unpivot_without_columns_gives_no_rows(spark):
    out = unpivot_tagged(spark.range(3), [("absent", {"side": "home"})], "cell", ["id"])
    assert out.columns == ["id", "source_ordinal", "side", "cell"] and out.count() == 0


@pytest.mark.parametrize("max_bitmaps", [0, 8, 8192])
def test_key_report_equals_the_plain_checks(spark, max_bitmaps):
    ids = [-40_000, -32_768, -1, 0, 1, 7, 8, 9, 32_768, 32_769, 99_999, 100_000]
    parent = spark.createDataFrame([(i,) for i in ids if i != 9] + [(None,)], "pk long")
    texts = spark.createDataFrame([("a",), ("b",), ("b",)], "pk string")
    rows = [(k % 50 or None, i, t) for k, (i, t) in enumerate((i, t) for i in [*ids, 2, 500_000, None] for t in ("a", "c", None))]
    child = spark.createDataFrame(rows * 2, "id int, fk long, tx string").repartition(3)
    got = {r.check_name: r.violations for r in constraint_report(
        {"id": (child, ["id"]), "parent": (parent, ["pk"])}, {"fk": (child, "fk", parent, "pk"), "tx": (child, "tx", texts, "pk")}, max_bitmaps).collect()}
    assert got == {"id": pk_violations(child, ["id"]).count(), "parent": 1, "fk": fk_orphans(child, "fk", parent, "pk").count(),
                   "tx": fk_orphans(child, "tx", texts, "pk").count()}
    assert got["fk"] == 2 * 3 * 3 and got["tx"] == 2 * 15
