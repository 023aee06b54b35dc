"""Physical plan checks: pruning, pushdown, broadcast sides, no single-task sorts."""

import re

from pyspark.sql import functions as F

from strata.plans import conformance as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark, sf01):
    li = C.table(spark, sf01, "lineitem").where("l_returnflag = 'R'").select("l_suppkey")
    p = plan(li)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>", p)


def single_partition_inputs(p):
    """Tables whose rows reach a single-partition exchange without passing an
    aggregate (an aggregate bounds what the single task receives)."""
    lines = p.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            scans, cut = [], None
            for below in lines[i + 1:]:
                d = len(below) - len(below.lstrip(" :+-"))
                if d <= depth:
                    break
                if cut is not None and d > cut:
                    continue
                cut = None
                if "HashAggregate" in below or "InMemoryRelation" in below:
                    cut = d
                    continue
                m = re.search(r"/([a-z_]+)\.parquet\]", below)
                if m:
                    scans.append(m.group(1))
            found.append(scans)
    return found


def test_team_record_broadcasts_dimensions_and_no_fact_in_one_task(spark, sf01):
    df = C.team_record(spark, sf01)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in p
    # Single-partition exchanges may only feed size-checked dimensions.
    for scans in single_partition_inputs(p):
        assert not {"lineitem", "orders", "events"} & set(scans), scans


def test_dense_keys_do_not_sort_in_one_task(spark, sf01):
    from strata.operators import dense_surrogate
    o = C.table(spark, sf01, "orders").select("o_orderkey", "o_orderstatus")
    df = dense_surrogate(o, ["o_orderstatus", "o_orderkey"], "id", part_rows=1000)
    # Buckets of one window each, told by broadcasts of one row a bucket; no sampled ranges, no global window.
    p = plan(df)
    assert "BroadcastHashJoin" in p and "SinglePartition" not in p and "rangepartitioning" not in p
    assert "InMemory" not in p
    rows = df.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, len(rows) + 1))
    assert [(r.o_orderstatus, r.o_orderkey) for r in rows] == sorted((r.o_orderstatus, r.o_orderkey) for r in rows)


def test_share_uses_scalar_subquery_not_cross_join(spark, sf01):
    df = C.period_share(spark, sf01)
    p = plan(df)
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_first_and_last_per_key_combine_map_side(spark):
    from pyspark.sql import functions as F
    from strata.operators import keep_first, latest_non_null
    # one key holds a third of the rows
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    for out in (keep_first(df, ["k"], ["o"]), latest_non_null(df, ["k"], ["v"], ["o"])):
        p = out._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"partial_(min|max)_by", p), p
    first = {r.k: r.o for r in keep_first(df, ["k"], ["o"]).collect()}
    assert first[0] == 0 and len(first) == 1 + 20000


def test_role_views_read_the_fact_once(spark, sf01):
    df = C.team_record(spark, sf01)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert p.count("lineitem.parquet") == 1


def test_key_checks_scan_each_child_once(spark, sf01):
    p = C.key_report(spark, sf01)._jdf.queryExecution().executedPlan().toString()
    assert p.count("lineitem.parquet") == 1
    # Parents of dense whole numbers are broadcast as bitmaps, so the child is shuffled for its text key and its own key alone.
    assert "bitmap_construct_agg" in p and p.count("BroadcastHashJoin") >= 2
    fk = C.fk_check(spark, sf01)._jdf.queryExecution().executedPlan().toString()
    assert all(fk.count(f"{t}.parquet") <= n for t, n in {"lineitem": 1, "orders": 2, "events": 1}.items())


def test_dense_key_rounds_take_no_python_and_one_pass_each(spark):
    """The bucket tables come through Arrow; the leading digit's range comes with the row count."""
    from strata.operators import dense_surrogate, surrogate
    passes = []
    ranges = surrogate._ranges
    surrogate._ranges = lambda *a: passes.append(1) or ranges(*a)
    try:
        df = dense_surrogate(spark.range(0, 4000).select((F.col("id") % 7).cast("int").alias("g"), "id"), ["g", "id"], "k", part_rows=100)
    finally:
        surrogate._ranges = ranges
    assert len(passes) == 2
    assert "pythonrdd" not in df._jdf.queryExecution().toRdd().toDebugString().lower()
    assert [(r.g, r.id) for r in df.orderBy("k").collect()] == sorted((k % 7, k) for k in range(4000))


def test_wide_jobs_strip_each_text_once(spark):
    """A text's strip is one expression of the plan, not one at every use."""
    from strata.plans import silver
    cols = ["Year", "Date", "Round", "home_team", "away_team", "home_score", "away_score", "home_xg", "away_xg", "home_penalty", "away_penalty",
            "Attendance", "Venue", "Host", "Referee", "home_goal"]
    raw = spark.range(3).select(*[F.concat(F.lit(" "), F.col("id").cast("string")).alias(c) for c in cols])
    mark = "trim(Date#"
    for df in (silver.transform_matches(raw, {}), silver.transform_goals(raw, {})):
        assert df._jdf.queryExecution().optimizedPlan().toString().count(mark) <= 2


def test_layer_facts_parse_silver_once(spark, sf01):
    from strata.plans import layer_queries as L
    p = plan(L._dims(spark, sf01)["goals"])
    assert "FileScan parquet" in p and "posexplode" not in p.lower() and "lineitem" not in p and "orders" not in p


def test_sessions_without_the_jvm_flag_get_small_methods(spark):
    from strata.session import compile_small
    limit = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(limit)
    other = spark.newSession()
    compile_small(other)
    assert other.conf.get(limit) == was  # these JVMs compile huge methods
