"""Conformance queries: the library's operators run over the driver tables.

Each query re-expresses one operator family of the medallion model on the
TPC-H-like tables (``region nation customer supplier part orders lineitem
events``) so it can be checked against an independent DuckDB formulation
(``ORACLE_SQL``).  The shared "trade" model maps the football star schema onto
those tables:

* a *match* is a line item; the home team is the customer's nation and the
  away team the supplier's nation; the home score is ``int(l_quantity)`` and
  the away score ``7 * l_linenumber``; the edition is ``year(o_orderdate)``;
  attendance is ``o_totalprice``;
* a *team* is a nation (confederation = region name); a *player* is a
  supplier (nationality = its nation);
* an *event* is a goal for the goal-fact and share queries.

All queries read whole tables.  Filters that remain are the semantics of the
query itself (the newest day, a page of a ranking).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as S
from ..operators import (append_missing, constraint_report, dense_surrogate, keep_first,
                         latest_non_null, lookup_join, pk_violations, role_playing_join, role_union)
from ..operators.surrogate import descending
from ..session import scratch_path
from ..sources.csv import read_multiheader_csv, write_multiheader_csv
from ..sources.partitions import read_latest
from ..sources.sinks import audited_writes
from . import marts, silver
from .serve import ServedCatalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def reg(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn
    return reg


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Shared trade model
# --------------------------------------------------------------------------

def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, both nation roles and the two scores."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Fact-to-fact join: both sides shuffle on the order key (AQE may
    # coalesce or split skewed partitions); dimensions use checked broadcasts.
    t = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    t = lookup_join(t, c, t["o_custkey"] == c["c_custkey"], "inner")
    t = lookup_join(t, s, t["l_suppkey"] == s["s_suppkey"], "inner")
    home = n.select(F.col("n_nationkey").alias("__hk"), F.col("n_name").alias("home_team"))
    away = n.select(F.col("n_nationkey").alias("__ak"), F.col("n_name").alias("away_team"))
    t = lookup_join(t, home, t["c_nationkey"] == home["__hk"], "left")
    t = lookup_join(t, away, t["s_nationkey"] == away["__ak"], "left")
    return t.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "o_totalprice",
        F.to_date("o_orderdate").alias("match_date"),
        F.year("o_orderdate").alias("year"),
        "home_team", "away_team",
        F.col("l_quantity").cast("int").alias("home_score"),
        (F.col("l_linenumber") * 7).cast("int").alias("away_score"),
    )


def dim_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension: nations keyed 1..n by name, confederation = region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    d = lookup_join(n, r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_name").alias("pays"), F.col("r_name").alias("confederation"),
        F.col("n_nationkey").cast("string").alias("code_pays"))
    return dense_surrogate(d, ["pays"], "id_equipe", id_type="int")


def dim_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edition dimension: order years keyed 1..n."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("annee")).distinct()
    return dense_surrogate(years, ["annee"], "id_edition", id_type="int")


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player dimension: suppliers keyed 1..n by name, nationality = nation."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    d = lookup_join(s, n, s["s_nationkey"] == n["n_nationkey"], "left").select(
        F.col("s_name").alias("nom"), F.col("n_name").alias("nationalite"),
        F.col("s_suppkey"))
    return dense_surrogate(d, ["nom", "s_suppkey"], "id_joueur", id_type="int")


def trade_fact(spark: SparkSession, sf_dir: str, teams: DataFrame | None = None,
               years: DataFrame | None = None) -> DataFrame:
    """Match fact over the trade lines: edition and both team roles as ids."""
    teams = teams if teams is not None else dim_nation(spark, sf_dir)
    years = years if years is not None else dim_year(spark, sf_dir)
    t = trade_lines(spark, sf_dir)
    t = lookup_join(t, years.select("id_edition", F.col("annee").alias("__y")),
                    F.col("year") == F.col("__y"), "left")
    t = role_playing_join(t, teams, "id_equipe", "pays",
                          {"home_team": "id_equipe_domicile", "away_team": "id_equipe_exterieur"})
    return t.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("id_edition").cast("int"),
        F.col("id_equipe_domicile").cast("int"),
        F.col("id_equipe_exterieur").cast("int"),
        F.col("year").cast("int").alias("annee"),
        F.col("home_score").alias("score_domicile"),
        F.col("away_score").alias("score_exterieur"),
        F.col("o_totalprice").alias("affluence"),
    )


def supplier_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as goals of their supplier; returned lines count as own goals."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_orderkey").alias("id_but"),
        (F.col("l_returnflag") == "R").alias("est_csc"),
        (F.col("l_linestatus") == "O").alias("est_penalty"))


def supplier_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = dim_supplier(spark, sf_dir)
    goals = supplier_goals(spark, sf_dir)
    goals = lookup_join(goals, players.select("id_joueur", "s_suppkey"), "s_suppkey", "inner")
    return marts.scorer_ranking(goals, players)


# SQL fragments of the same model for the oracle side.
_SQL_TRADE = """
trade AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_discount,
         l.l_tax, l.l_returnflag, l.l_linestatus, o.o_totalprice,
         CAST(o.o_orderdate AS DATE) AS match_date, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         hn.n_name AS home_team, an.n_name AS away_team,
         CAST(l.l_quantity AS INTEGER) AS home_score, CAST(7 * l.l_linenumber AS INTEGER) AS away_score
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation hn ON c.c_nationkey = hn.n_nationkey
  LEFT JOIN nation an ON s.s_nationkey = an.n_nationkey
)"""
_SQL_DIMS = """
dteam AS (
  SELECT CAST(row_number() OVER (ORDER BY n.n_name) AS INTEGER) AS id_equipe, n.n_name AS pays,
         r.r_name AS confederation, CAST(n.n_nationkey AS VARCHAR) AS code_pays
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
dyear AS (
  SELECT CAST(row_number() OVER (ORDER BY annee) AS INTEGER) AS id_edition, annee
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS annee FROM orders)
)"""
_SQL_FACT = """
fact AS (
  SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, t.l_returnflag, t.l_linestatus,
         y.id_edition, h.id_equipe AS id_equipe_domicile, a.id_equipe AS id_equipe_exterieur,
         t.year AS annee, t.home_score AS score_domicile, t.away_score AS score_exterieur,
         t.o_totalprice AS affluence
  FROM trade t LEFT JOIN dyear y ON t.year = y.annee
  LEFT JOIN dteam h ON t.home_team = h.pays
  LEFT JOIN dteam a ON t.away_team = a.pays
)"""
_SQL_RANKING = """
dplayer AS (
  SELECT CAST(row_number() OVER (ORDER BY s.s_name, s.s_suppkey) AS INTEGER) AS id_joueur,
         s.s_suppkey, s.s_name AS nom, n.n_name AS nationalite
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
counted AS (
  SELECT p.id_joueur, count(l.l_orderkey) AS nb_buts,
         CAST(coalesce(sum(CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END), 0) AS BIGINT) AS nb_penaltys
  FROM lineitem l JOIN dplayer p ON l.l_suppkey = p.s_suppkey
  WHERE NOT (l.l_returnflag = 'R')
  GROUP BY p.id_joueur
),
ranking AS (
  SELECT row_number() OVER (ORDER BY c.nb_buts DESC, c.id_joueur) AS rang, c.id_joueur,
         p.nom, p.nationalite, c.nb_buts, c.nb_penaltys
  FROM counted c LEFT JOIN dplayer p ON c.id_joueur = p.id_joueur
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


# --------------------------------------------------------------------------
# Column expressions (N*)
# --------------------------------------------------------------------------

# Fixed values of the probe dictionary for canonical labels.
NATION_LABELS = {"NATION 1": "Nation One", "NATION 7": "Nation Seven", "NATION 13": "Nation Thirteen"}


@query("canon_label", """
WITH r AS (
  SELECT n_nationkey,
         ' ' || replace(n_name, '_', ' ' || chr(9) || chr(160) || ' ') || chr(8195) AS raw_label
  FROM nation
), c AS (
  SELECT n_nationkey, raw_label,
         trim(regexp_replace(raw_label, '[\\s\\x{A0}\\x{2003}]+', ' ', 'g')) AS norm
  FROM r
)
SELECT n_nationkey, raw_label,
       CASE norm WHEN 'NATION 1' THEN 'Nation One' WHEN 'NATION 7' THEN 'Nation Seven'
                 WHEN 'NATION 13' THEN 'Nation Thirteen' ELSE norm END AS label
FROM c
""")
def canon_label(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    pad = " \t\u00a0 "  # space, tab, no-break space, space
    raw = F.concat(F.lit(" "), F.replace("n_name", F.lit("_"), F.lit(pad)), F.lit("\u2003"))
    return n.select("n_nationkey", raw.alias("raw_label")).select(
        "n_nationkey", "raw_label", S.canonical_label("raw_label", NATION_LABELS).alias("label"))


@query("snake_values", """
WITH p AS (SELECT p_partkey, p_type || ' ' || p_name || '+' || p_brand || '%' AS raw_text FROM part)
SELECT p_partkey, raw_text,
       coalesce(nullif(lower(regexp_replace(regexp_replace(
           replace(replace(replace(trim(raw_text), '%', '_pct'), '+', '_plus_'), '/', '_per_'),
           '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g')), ''), 'col') AS snake
FROM p
""")
def snake_values(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.concat_ws("", "p_type", F.lit(" "), "p_name", F.lit("+"), "p_brand", F.lit("%"))
    return p.select("p_partkey", raw.alias("raw_text")).select(
        "p_partkey", "raw_text", S.snake_case("raw_text").alias("snake"))


@query("row_key", """
SELECT substr(md5(concat_ws('|', coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'None'),
                             coalesce(o_orderstatus, 'None'), coalesce(o_orderpriority, 'None'))), 1, 12)
         AS row_key,
       o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, o_orderpriority
FROM orders
""")
def row_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_orderstatus", "o_orderpriority")
    return o.select(S.row_key("order_date", "o_orderstatus", "o_orderpriority").alias("row_key"),
                    "o_orderkey", "order_date", "o_orderstatus", "o_orderpriority")


@query("to_date_coerce", """
WITH t AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                            WHEN 'F' THEN strftime(o_orderdate, '%Y-%m') || '-32'
                            ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text
  FROM orders
)
SELECT o_orderkey, date_text, CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) AS parsed_date FROM t
""")
def to_date_coerce(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.col("o_orderstatus") == "F",
                  F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-32")))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    return o.select("o_orderkey", txt.alias("date_text")).select(
        "o_orderkey", "date_text", S.to_date_coerce("date_text").alias("parsed_date"))


@query("num_coerce", """
WITH t AS (
  SELECT c_custkey, c_acctbal,
         CASE c_mktsegment WHEN 'BUILDING' THEN regexp_extract(c_name, '(\\d+)$', 1) || 'x'
                           WHEN 'MACHINERY' THEN regexp_extract(c_name, '(\\d+)$', 1) || '.0'
                           WHEN 'FURNITURE' THEN regexp_extract(c_name, '(\\d+)$', 1) || '.5'
                           WHEN 'HOUSEHOLD' THEN ' ' || regexp_extract(c_name, '(\\d+)$', 1) || ' '
                           ELSE regexp_extract(c_name, '(\\d+)$', 1) END AS num_text
  FROM customer
), d AS (SELECT *, TRY_CAST(trim(num_text) AS DOUBLE) AS as_double FROM t)
SELECT c_custkey, num_text,
       CASE WHEN as_double IS NOT NULL AND as_double = floor(as_double) THEN CAST(as_double AS BIGINT) END
         AS as_long,
       as_double,
       TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS acctbal
FROM d
""")
def num_coerce(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    digits = F.regexp_extract("c_name", r"(\d+)$", 1)
    seg = F.col("c_mktsegment")
    txt = (F.when(seg == "BUILDING", F.concat(digits, F.lit("x")))
            .when(seg == "MACHINERY", F.concat(digits, F.lit(".0")))
            .when(seg == "FURNITURE", F.concat(digits, F.lit(".5")))
            .when(seg == "HOUSEHOLD", F.concat(F.lit(" "), digits, F.lit(" ")))
            .otherwise(digits))
    t = c.select("c_custkey", txt.alias("num_text"), F.col("c_acctbal").cast("string").alias("bal"))
    return t.select("c_custkey", "num_text", S.to_long("num_text").alias("as_long"),
                    S.to_double("num_text").alias("as_double"), S.to_double("bal").alias("acctbal"))


@query("kickoff_parse", """
WITH e AS (
  SELECT event_id, ts, event_type, hour(ts) AS h, minute(ts) AS m FROM events
), t AS (
  SELECT event_id, ts,
         CASE event_type
           WHEN 'view' THEN CAST(h AS VARCHAR) || ':' || lpad(CAST(m AS VARCHAR), 2, '0')
           WHEN 'error' THEN '25:' || lpad(CAST(m AS VARCHAR), 2, '0') || ' ('
                || lpad(CAST((h + 9) % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || ')'
           WHEN 'click' THEN '  ' || CAST(h AS VARCHAR) || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || '  ('
                || lpad(CAST((h + 9) % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || ')'
           ELSE CAST(h AS VARCHAR) || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || ' ('
                || lpad(CAST((h + 9) % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || ')'
         END AS kick_text
  FROM e
), g AS (
  SELECT event_id, ts, kick_text,
         nullif(regexp_extract(kick_text, '^\\s*(\\d{1,2}:\\d{2})(?:\\s*\\((\\d{1,2}:\\d{2})\\))?', 1), '') AS l_raw,
         nullif(regexp_extract(kick_text, '^\\s*(\\d{1,2}:\\d{2})(?:\\s*\\((\\d{1,2}:\\d{2})\\))?', 2), '') AS o_raw
  FROM t
), n AS (
  SELECT event_id, ts, kick_text,
         CASE WHEN CAST(split_part(l_raw, ':', 1) AS INTEGER) BETWEEN 0 AND 23
                   AND CAST(split_part(l_raw, ':', 2) AS INTEGER) BETWEEN 0 AND 59
              THEN lpad(split_part(l_raw, ':', 1), 2, '0') || ':' || split_part(l_raw, ':', 2) END
           AS kickoff_local_time,
         CASE WHEN CAST(split_part(o_raw, ':', 1) AS INTEGER) BETWEEN 0 AND 23
                   AND CAST(split_part(o_raw, ':', 2) AS INTEGER) BETWEEN 0 AND 59
              THEN lpad(split_part(o_raw, ':', 1), 2, '0') || ':' || split_part(o_raw, ':', 2) END
           AS kickoff_other_time
  FROM g
)
SELECT event_id, kick_text, kickoff_local_time, kickoff_other_time,
       CASE WHEN kickoff_local_time IS NOT NULL
            THEN CAST(strftime(ts, '%Y-%m-%d') || ' ' || kickoff_local_time AS TIMESTAMP) END
         AS kickoff_datetime_local
FROM n
""")
def kickoff_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    h, m = F.hour("ts"), F.lpad(F.minute("ts").cast("string"), 2, "0")
    local = F.concat(h.cast("string"), F.lit(":"), m)
    other = F.concat(F.lpad(((h + 9) % 24).cast("string"), 2, "0"), F.lit(":"), m)
    et = F.col("event_type")
    txt = (F.when(et == "view", local)
            .when(et == "error", F.concat(F.lit("25:"), m, F.lit(" ("), other, F.lit(")")))
            .when(et == "click", F.concat(F.lit("  "), local, F.lit("  ("), other, F.lit(")")))
            .otherwise(F.concat(local, F.lit(" ("), other, F.lit(")"))))
    t = e.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), txt.alias("kick_text"))
    lt, ot = S.parse_kickoff("kick_text")
    t = t.select("event_id", "day", "kick_text", lt.alias("kickoff_local_time"),
                 ot.alias("kickoff_other_time"))
    return t.select("event_id", "kick_text", "kickoff_local_time", "kickoff_other_time",
                    S.local_timestamp("day", "kickoff_local_time").alias("kickoff_datetime_local"))


@query("score_split", """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_returnflag = 'R'
                THEN '(' || CAST(l_linenumber AS VARCHAR) || ') ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
                     || '–' || CAST(l_linenumber AS VARCHAR) || ' (' || CAST(CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) || ')'
              WHEN l_returnflag = 'A'
                THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '–' || CAST(l_linenumber AS VARCHAR)
              WHEN l_linestatus = 'O' THEN 'abandoned ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' - ' || CAST(l_linenumber AS VARCHAR) || ' aet'
         END AS score_text
  FROM lineitem
), n AS (
  SELECT *, regexp_extract_all(regexp_replace(score_text, '\\(\\d+\\)', '', 'g'), '\\d+') AS nums FROM t
)
SELECT l_orderkey, l_linenumber, l_partkey, score_text,
       CASE WHEN len(nums) >= 2 THEN CAST(nums[1] AS BIGINT) END AS home_score,
       CASE WHEN len(nums) >= 2 THEN CAST(nums[2] AS BIGINT) END AS away_score
FROM n
""")
def score_split(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int").cast("string")
    ln = F.col("l_linenumber").cast("string")
    txt = (F.when(F.col("l_returnflag") == "R",
                  F.concat(F.lit("("), ln, F.lit(") "), q, F.lit("–"), ln, F.lit(" ("),
                           (F.col("l_quantity").cast("int") % 5).cast("string"), F.lit(")")))
            .when(F.col("l_returnflag") == "A", F.concat(q, F.lit("–"), ln))
            .when(F.col("l_linestatus") == "O", F.concat(F.lit("abandoned "), q))
            .otherwise(F.concat(q, F.lit(" - "), ln, F.lit(" aet"))))
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", txt.alias("score_text"))
    hs, as_ = S.split_score("score_text")
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "score_text",
                    hs.alias("home_score"), as_.alias("away_score"))


def _goal_tokens():
    q2 = (F.col("l_quantity").cast("int") * 2).cast("string")
    stoppage = F.round(F.col("l_tax") * 100).cast("int").cast("string")
    tok1 = F.when(F.col("l_discount") >= 0.05, F.concat(q2, F.lit("+"), stoppage)).otherwise(q2)
    tok2 = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("x"), F.col("l_linenumber").cast("string"))) \
            .otherwise((F.col("l_linenumber") * 13).cast("string"))
    return tok1, tok2


@query("goal_cells", _with(_SQL_TRADE, """
typed AS (
  SELECT *, CASE l_returnflag WHEN 'N' THEN 'open_play' WHEN 'R' THEN 'penalty' ELSE 'own_goal' END AS goal_type,
         CASE l_linestatus WHEN 'O' THEN 'home' ELSE 'away' END AS side
  FROM trade
),
g AS (
  SELECT match_date, year, home_team, away_team, goal_type, side,
         'Supplier ' || CAST(l_suppkey AS VARCHAR) AS scorer,
         CAST(CAST(l_quantity AS INTEGER) * 2 AS BIGINT) AS minute,
         CAST(CASE WHEN l_discount >= 0.05 THEN CAST(round(l_tax * 100) AS INTEGER) ELSE 0 END AS BIGINT)
           AS stoppage_time
  FROM typed
  UNION ALL
  SELECT match_date, year, home_team, away_team, goal_type, side,
         'Part ' || CAST(l_partkey AS VARCHAR) AS scorer,
         CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber * 13 END AS BIGINT) AS minute,
         CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE 0 END AS BIGINT) AS stoppage_time
  FROM typed
)
SELECT substr(md5(concat_ws('|', coalesce(CAST(match_date AS VARCHAR), 'None'), coalesce(home_team, 'None'),
                             coalesce(away_team, 'None'))), 1, 12) AS match_key,
       year, match_date,
       CASE side WHEN 'home' THEN home_team ELSE away_team END AS team,
       CASE side WHEN 'home' THEN away_team ELSE home_team END AS opponent,
       side, scorer, goal_type,
       goal_type = 'penalty' AS is_penalty, goal_type = 'own_goal' AS is_own_goal,
       minute, stoppage_time, minute + stoppage_time AS minute_absolute,
       CASE WHEN minute IS NULL THEN NULL WHEN minute <= 45 THEN '1re mi-temps'
            WHEN minute <= 90 THEN '2e mi-temps' ELSE 'prolongation' END AS period
FROM g
"""))
def goal_cells(spark, sf_dir):
    """Packed goal cells built per line item, unpivoted and exploded (TJ2 core)."""
    t = trade_lines(spark, sf_dir)
    tok1, tok2 = _goal_tokens()
    gtype = F.when(F.col("l_returnflag") == "N", "open_play") \
             .when(F.col("l_returnflag") == "R", "penalty").otherwise("own_goal")
    side = F.when(F.col("l_linestatus") == "O", "home").otherwise("away")
    marker = F.when(gtype == "penalty", F.lit(" (P)")).otherwise(F.lit(""))
    cell = F.concat(F.lit(" Supplier "), F.col("l_suppkey").cast("string"), F.lit(" · "), tok1,
                    F.lit(" | Part "), F.col("l_partkey").cast("string"), marker, F.lit(" ·"),
                    tok2, F.lit(" |"))
    cols = {}
    for src, tags in silver.GOAL_SOURCES:
        cols[src] = F.when((side == tags["side"]) & (gtype == tags["goal_type"]), cell)
    raw = t.select("match_date", "year", "home_team", "away_team",
                   *[v.alias(k) for k, v in cols.items()])
    goals = silver.explode_goals(raw, "home_team", "away_team", "match_date", "year")
    return goals.select(*silver.GOAL_COLUMNS)


@query("silver_matches", _with(_SQL_TRADE, """
t AS (
  SELECT year, match_date, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_discount, l_tax,
         o_totalprice,
         away_team AS away_raw,
         CASE replace(home_team, '_', ' ') WHEN 'NATION 1' THEN 'Nation One' WHEN 'NATION 7' THEN 'Nation Seven'
              WHEN 'NATION 13' THEN 'Nation Thirteen' ELSE replace(home_team, '_', ' ') END AS home_team,
         CASE replace(away_team, '_', ' ') WHEN 'NATION 1' THEN 'Nation One' WHEN 'NATION 7' THEN 'Nation Seven'
              WHEN 'NATION 13' THEN 'Nation Thirteen' ELSE replace(away_team, '_', ' ') END AS away_team,
         home_score, away_score
  FROM trade
)
SELECT substr(md5(concat_ws('|', coalesce(CAST(match_date AS VARCHAR), 'None'), coalesce(home_team, 'None'),
                             coalesce(away_team, 'None'))), 1, 12) AS match_key,
       CAST(year AS BIGINT) AS year, match_date, 'Round ' || CAST(l_linenumber AS VARCHAR) AS round,
       home_team, away_team, CAST(home_score AS BIGINT) AS home_score,
       CAST(CASE WHEN l_linestatus = 'O' THEN NULL ELSE away_score END AS BIGINT) AS away_score,
       l_discount * 10 AS home_xg, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_tax * 10 END AS away_xg,
       CAST(CASE WHEN l_returnflag = 'R' THEN l_linenumber END AS BIGINT) AS penalty_home,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(round(l_tax * 100) AS INTEGER) END AS BIGINT)
         AS penalty_away,
       l_returnflag = 'R' AND l_linestatus = 'F' AS went_to_penalties,
       CAST(floor(o_totalprice) AS BIGINT) AS attendance,
       CASE WHEN l_linenumber > 3 THEN 'Stadium ' || CAST(l_suppkey AS VARCHAR) || ', Annex'
            ELSE 'Stadium ' || CAST(l_suppkey AS VARCHAR) END AS venue_name,
       CASE WHEN l_linenumber > 3 THEN away_raw END AS venue_city,
       home_team AS host, 'Ref ' || CAST(l_partkey AS VARCHAR) AS referee
FROM t
"""))
def silver_matches(spark, sf_dir):
    """The whole matches table job over all-string raw rows built from the trade lines."""
    t = trade_lines(spark, sf_dir)
    pad = " \t "

    def txt(c):
        return c.cast("string")

    ln = F.col("l_linenumber")
    home = F.concat(F.lit(pad), F.replace("home_team", F.lit("_"), F.lit(" ")), F.lit(" "))
    away = F.concat(F.replace("away_team", F.lit("_"), F.lit("  ")), F.lit(pad))
    venue = F.when(ln > 3, F.concat(F.lit(" Stadium "), txt(F.col("l_suppkey")), F.lit(", Annex, "),
                                    F.col("away_team"), F.lit(" ")))
    venue = venue.otherwise(F.concat(F.lit("Stadium "), txt(F.col("l_suppkey"))))
    raw = t.select(
        txt(F.col("year")).alias("Year"),
        F.date_format("match_date", "yyyy-MM-dd").alias("Date"),
        F.concat(F.lit(" Round "), txt(ln)).alias("Round"),
        home.alias("home_team"), away.alias("away_team"),
        F.concat(txt(F.col("home_score")), F.lit(".0")).alias("home_score"),
        F.when(F.col("l_linestatus") != "O", txt(F.col("away_score"))).alias("away_score"),
        txt(F.col("l_discount") * 10).alias("home_xg"),
        F.when(F.col("l_returnflag") != "A", txt(F.col("l_tax") * 10)).otherwise(F.lit("n/a")).alias("away_xg"),
        F.when(F.col("l_returnflag") == "R", txt(ln)).alias("home_penalty"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
               txt(F.round(F.col("l_tax") * 100).cast("int"))).alias("away_penalty"),
        txt(F.floor("o_totalprice")).alias("Attendance"),
        venue.alias("Venue"),
        home.alias("Host"),
        F.concat(F.lit(" Ref "), txt(F.col("l_partkey")), F.lit("\u00a0")).alias("Referee"),
    )
    return silver.transform_matches(raw, NATION_LABELS)


@query("period_bucket", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_quantity AS INTEGER) * 2 END AS minute,
       CASE WHEN l_returnflag = 'A' THEN NULL
            WHEN CAST(l_quantity AS INTEGER) * 2 <= 45 THEN '1re mi-temps'
            WHEN CAST(l_quantity AS INTEGER) * 2 <= 90 THEN '2e mi-temps' ELSE 'prolongation' END AS period
FROM lineitem
""")
def period_bucket(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    minute = F.when(F.col("l_returnflag") != "A", F.col("l_quantity").cast("int") * 2)
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", minute.alias("minute"))
    return t.withColumn("period", S.period_of_minute("minute"))


@query("rsplit_last", """
WITH t AS (
  SELECT p_partkey,
         CASE WHEN p_size > 25 THEN p_type || ', ' || p_name || ', ' || p_brand ELSE p_name END AS venue_text,
         CASE WHEN p_size > 10 THEN p_name || ' - ' || CAST(p_size AS VARCHAR) ELSE p_name || ' - n/a' END
           AS scorer_text
  FROM part
)
SELECT p_partkey,
       CASE WHEN strpos(venue_text, ',') > 0 THEN trim(regexp_extract(venue_text, '^(.*),', 1))
            ELSE trim(venue_text) END AS venue_name,
       CASE WHEN strpos(venue_text, ',') > 0 THEN trim(regexp_extract(venue_text, ',([^,]*)$', 1)) END
         AS venue_city,
       trim(regexp_extract(scorer_text, '^(.*)-', 1)) AS scorer_name,
       CASE WHEN TRY_CAST(trim(regexp_extract(scorer_text, '-([^-]*)$', 1)) AS DOUBLE) IS NOT NULL
            THEN CAST(TRY_CAST(trim(regexp_extract(scorer_text, '-([^-]*)$', 1)) AS DOUBLE) AS BIGINT) END
         AS scorer_goals
FROM t
""")
def rsplit_last(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    venue = F.when(F.col("p_size") > 25, F.concat_ws(", ", "p_type", "p_name", "p_brand")) \
             .otherwise(F.col("p_name"))
    scorer = F.when(F.col("p_size") > 10, F.concat_ws(" - ", F.col("p_name"), F.col("p_size").cast("string"))) \
              .otherwise(F.concat(F.col("p_name"), F.lit(" - n/a")))
    t = p.select("p_partkey", venue.alias("v"), scorer.alias("s"))
    vh, vt = S.rsplit_last("v", ",")
    sh, st = S.rsplit_last("s", "-")
    return t.select("p_partkey", vh.alias("venue_name"), vt.alias("venue_city"),
                    sh.alias("scorer_name"), S.to_long(st).alias("scorer_goals"))


@query("flag_strip", """
WITH t AS (
  SELECT s_suppkey,
         CASE WHEN s_acctbal > 5000 THEN s_name || '  (Neutral Site)' ELSE s_name END AS venue_raw,
         CASE WHEN s_acctbal > 2000 THEN s_nationkey END AS pen_home,
         CASE WHEN s_acctbal < 8000 THEN s_suppkey END AS pen_away
  FROM supplier
)
SELECT s_suppkey, coalesce(contains(venue_raw, '(Neutral Site)'), false) AS neutral_site,
       trim(regexp_replace(venue_raw, '\\s*\\(Neutral Site\\)', '', 'g')) AS venue,
       pen_home IS NOT NULL AND pen_away IS NOT NULL AS went_to_penalties
FROM t
""")
def flag_strip(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    raw = F.when(F.col("s_acctbal") > 5000, F.concat(F.col("s_name"), F.lit("  (Neutral Site)"))) \
           .otherwise(F.col("s_name"))
    t = s.select("s_suppkey", raw.alias("venue_raw"),
                 F.when(F.col("s_acctbal") > 2000, F.col("s_nationkey")).alias("pen_home"),
                 F.when(F.col("s_acctbal") < 8000, F.col("s_suppkey")).alias("pen_away"))
    flag, venue = S.flag_and_strip("venue_raw")
    return t.select("s_suppkey", flag.alias("neutral_site"), venue.alias("venue"),
                    S.both_present("pen_home", "pen_away").alias("went_to_penalties"))


# --------------------------------------------------------------------------
# Unions, dimensions, keys (U*, A6-A8, J5, W1)
# --------------------------------------------------------------------------

@query("snapshot_union", """
SELECT CAST(ts AS DATE) AS snapshot_date, event_id, user_id, event_type, value FROM events
""")
def snapshot_union(spark, sf_dir):
    """Two snapshot "files" with different columns, unioned by name."""
    e = table(spark, sf_dir, "events")
    fname = F.concat(F.lit("events_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))
    even = e.where(F.dayofmonth("ts") % 2 == 0).select(
        "event_id", "user_id", "event_type", "value", fname.alias("source_file"))
    odd = e.where(F.dayofmonth("ts") % 2 == 1).select(
        "props", "event_id", "user_id", "event_type", "value", fname.alias("source_file"))
    both = even.unionByName(odd, allowMissingColumns=True)
    return both.select(S.snapshot_date_from_name("source_file").alias("snapshot_date"),
                       "event_id", "user_id", "event_type", "value")


@query("dim_union", """
WITH labels AS (
  SELECT n.n_name AS label FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION ALL SELECT n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL SELECT r_name FROM region
  UNION ALL SELECT c_mktsegment FROM customer
  UNION ALL SELECT CASE WHEN c_acctbal < 0 THEN '   ' END FROM customer
), d AS (SELECT DISTINCT label FROM labels WHERE label IS NOT NULL AND trim(label) <> '')
SELECT CAST(row_number() OVER (ORDER BY label) AS INTEGER) AS id_label, label FROM d
""")
def dim_union(spark, sf_dir):
    """Conformed label dimension gathered from columns of several tables."""
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    r = table(spark, sf_dir, "region")
    cn = lookup_join(c, n, c["c_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("n_name").alias("cust_nation"), "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, F.lit("   ")).alias("blank"))
    sn = lookup_join(s, n, s["s_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("n_name").alias("supp_nation"))
    from .gold import team_labels
    labels = team_labels([(cn, ["cust_nation", "c_mktsegment", "blank"]), (sn, ["supp_nation"]),
                          (r, ["r_name"])], "label")
    return dense_surrogate(labels, ["label"], "id_label", id_type="int")


@query("dim_latest_attr", """
WITH t AS (SELECT user_id, ts, event_id, nullif(event_type, 'error') AS last_type,
                  CASE WHEN event_type = 'purchase' THEN value END AS last_value FROM events),
lt AS (SELECT user_id, last_type FROM (
         SELECT user_id, last_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM t WHERE last_type IS NOT NULL) WHERE rn = 1),
lv AS (SELECT user_id, last_value FROM (
         SELECT user_id, last_value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM t WHERE last_value IS NOT NULL) WHERE rn = 1)
SELECT c.c_custkey, c.c_name, lt.last_type, lv.last_value
FROM customer c LEFT JOIN lt ON lt.user_id = c.c_custkey LEFT JOIN lv ON lv.user_id = c.c_custkey
""")
def dim_latest_attr(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("last_type"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_value"))
    latest = latest_non_null(e, ["user_id"], ["last_type", "last_value"], ["ts", "event_id"])
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    out = lookup_join(c, latest, c["c_custkey"] == latest["user_id"], "left", check="adaptive")
    return out.select("c_custkey", "c_name", "last_type", "last_value")


@query("dim_first_dup", """
SELECT c_mktsegment, c_nationkey, c_custkey, c_name, c_acctbal FROM (
  SELECT coalesce(c_mktsegment, '') AS c_mktsegment, c_nationkey, c_custkey, c_name, c_acctbal,
         row_number() OVER (PARTITION BY coalesce(c_mktsegment, ''), c_nationkey ORDER BY c_custkey) AS rn
  FROM customer) WHERE rn = 1
""")
def dim_first_dup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        S.null_to_empty("c_mktsegment").alias("c_mktsegment"), "c_nationkey", "c_custkey",
        "c_name", "c_acctbal")
    return keep_first(c, ["c_mktsegment", "c_nationkey"], ["c_custkey"])


@query("dim_antijoin", """
WITH known AS (SELECT c_name AS nom, c_mktsegment AS poste, CAST(c_nationkey AS VARCHAR) AS nationalite
               FROM customer),
cand AS (SELECT DISTINCT 'Customer#' || lpad(CAST(user_id + CASE WHEN event_type = 'signup' THEN 100000 ELSE 0 END
                                                  AS VARCHAR), 9, '0') AS nom FROM events),
allp AS (SELECT nom, poste, nationalite FROM known
         UNION ALL SELECT nom, NULL, NULL FROM cand WHERE nom NOT IN (SELECT nom FROM known))
SELECT CAST(row_number() OVER (ORDER BY nom) AS INTEGER) AS id_joueur, nom, poste, nationalite FROM allp
""")
def dim_antijoin(spark, sf_dir):
    """Known members plus referenced-but-unknown ones (D4 shape)."""
    c = table(spark, sf_dir, "customer")
    known = keep_first(c.select(F.col("c_name").alias("nom"), F.col("c_mktsegment").alias("poste"),
                                F.col("c_nationkey").cast("string").alias("nationalite"), "c_custkey"),
                       ["nom"], ["c_custkey"]).select("nom", "poste", "nationalite")
    e = table(spark, sf_dir, "events")
    shift = F.when(F.col("event_type") == "signup", F.lit(100000)).otherwise(F.lit(0))
    cand = e.select(F.concat(F.lit("Customer#"),
                             F.lpad((F.col("user_id") + shift).cast("string"), 9, "0")).alias("nom"))
    return dense_surrogate(append_missing(known, cand, "nom"), ["nom"], "id_joueur", id_type="int")


@query("surrogate_key", """
SELECT row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS id,
       o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS h
FROM orders
""")
def surrogate_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("h"))
    return dense_surrogate(o, ["h", "o_orderkey"], "id")


@query("surrogate_hot_key", """
SELECT row_number() OVER (ORDER BY CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END, l_quantity DESC, l_orderkey, l_linenumber) AS id,
       l_orderkey, l_linenumber
FROM lineitem
""")
def surrogate_hot_key(spark, sf_dir):
    """A leading value of a third of all rows, refined into many buckets."""
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_returnflag")).alias("lead"), "l_quantity", "l_orderkey", "l_linenumber")
    return dense_surrogate(li, ["lead", descending("l_quantity"), "l_orderkey", "l_linenumber"], "id", part_rows=5_000).drop("lead", "l_quantity")


# --------------------------------------------------------------------------
# Facts, checks, marts (F*, C*, M*)
# --------------------------------------------------------------------------

@query("fact_match", _with(_SQL_TRADE, _SQL_DIMS, """
dpt AS (SELECT CAST(row_number() OVER (ORDER BY p_type, p_brand) AS INTEGER) AS id_stade, p_type, p_brand
        FROM (SELECT DISTINCT p_type, p_brand FROM part))
SELECT t.l_orderkey, t.l_linenumber, y.id_edition,
       h.id_equipe AS id_equipe_domicile, a.id_equipe AS id_equipe_exterieur, d.id_stade,
       t.year AS annee, t.home_score AS score_domicile, t.away_score AS score_exterieur
FROM trade t
LEFT JOIN dyear y ON t.year = y.annee
LEFT JOIN dteam h ON t.home_team = h.pays
LEFT JOIN dteam a ON t.away_team = a.pays
LEFT JOIN part p ON t.l_partkey = p.p_partkey
LEFT JOIN dpt d ON p.p_type = d.p_type AND p.p_brand = d.p_brand
"""))
def fact_match(spark, sf_dir):
    """Trade fact with both team roles and a composite-key dimension."""
    fact = trade_fact(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    dpt = dense_surrogate(part.select("p_type", "p_brand").distinct(), ["p_type", "p_brand"], "id_stade", id_type="int")
    f = lookup_join(fact, part, fact["l_partkey"] == part["p_partkey"], "left")
    d = dpt.select("id_stade", F.col("p_type").alias("__t"), F.col("p_brand").alias("__b"))
    f = lookup_join(f, d, (f["p_type"] == d["__t"]) & (f["p_brand"] == d["__b"]), "left")
    return f.select("l_orderkey", "l_linenumber", "id_edition", "id_equipe_domicile",
                    "id_equipe_exterieur", F.col("id_stade").cast("int"), "annee",
                    "score_domicile", "score_exterieur")


@query("fact_goal", """
WITH dj AS (SELECT CAST(row_number() OVER (ORDER BY c_name, c_custkey) AS INTEGER) AS id_joueur, c_custkey
            FROM customer)
SELECT row_number() OVER (ORDER BY e.ts, e.event_id) AS id_but, e.event_id, dj.id_joueur,
       CAST(minute(e.ts) AS INTEGER) AS minute,
       CAST(e.event_type = 'purchase' AS BOOLEAN) AS est_penalty,
       CAST(e.event_type = 'error' AS BOOLEAN) AS est_csc
FROM events e LEFT JOIN dj ON e.user_id = dj.c_custkey
""")
def fact_goal(spark, sf_dir):
    """Events as goals: player lookup, boolean flags, dense goal id."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    dj = dense_surrogate(c, ["c_name", "c_custkey"], "id_joueur", id_type="int")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    f = lookup_join(e, dj.select("id_joueur", "c_custkey"), e["user_id"] == F.col("c_custkey"), "left")
    f = f.select("event_id", "ts", "id_joueur", F.minute("ts").cast("int").alias("minute"),
                 (F.col("event_type") == "purchase").cast("boolean").alias("est_penalty"),
                 (F.col("event_type") == "error").cast("boolean").alias("est_csc"))
    return dense_surrogate(f, ["ts", "event_id"], "id_but").drop("ts")


@query("pk_check", """
SELECT 'lineitem' AS tbl, concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS key_text,
       count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
UNION ALL
SELECT 'orders', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey
HAVING count(*) > 1 OR o_orderkey IS NULL
""")
def pk_check(spark, sf_dir):
    li = pk_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    o = pk_violations(table(spark, sf_dir, "orders"), ["o_orderkey"])
    key = lambda *cs: F.concat_ws("|", *[F.col(c).cast("string") for c in cs])
    return (li.select(F.lit("lineitem").alias("tbl"), key("l_orderkey", "l_linenumber").alias("key_text"), "n_rows")
              .unionAll(o.select(F.lit("orders"), key("o_orderkey"), "n_rows")))


_FK_ORACLE = """
SELECT 'orders.o_custkey' AS check_name, 'foreign_key' AS kind, count(*) AS violations
FROM orders x WHERE x.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = x.o_custkey)
UNION ALL SELECT 'lineitem.l_orderkey', 'foreign_key', count(*)
FROM lineitem x WHERE x.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = x.l_orderkey)
UNION ALL SELECT 'lineitem.l_suppkey', 'foreign_key', count(*)
FROM lineitem x WHERE x.l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier p WHERE p.s_suppkey = x.l_suppkey)
UNION ALL SELECT 'lineitem.l_partkey', 'foreign_key', count(*)
FROM lineitem x WHERE x.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = x.l_partkey)
UNION ALL SELECT 'customer.c_nationkey', 'foreign_key', count(*)
FROM customer x WHERE x.c_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation p WHERE p.n_nationkey = x.c_nationkey)
UNION ALL SELECT 'supplier.s_nationkey', 'foreign_key', count(*)
FROM supplier x WHERE x.s_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation p WHERE p.n_nationkey = x.s_nationkey)
UNION ALL SELECT 'events.user_id', 'foreign_key', count(*)
FROM events x WHERE x.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = x.user_id)
UNION ALL SELECT 'orders.o_custkey->building_customer', 'foreign_key', count(*)
FROM orders x WHERE x.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = x.o_custkey AND p.c_mktsegment = 'BUILDING')
"""


@query("fk_check", _FK_ORACLE)
def fk_check(spark, sf_dir):
    """Seven referential checks plus one against a conformed (filtered) parent."""
    t = {n: table(spark, sf_dir, n) for n in
         ("orders", "customer", "lineitem", "supplier", "part", "nation", "events")}
    building = t["customer"].where(F.col("c_mktsegment") == "BUILDING")
    fks = {
        "orders.o_custkey": (t["orders"], "o_custkey", t["customer"], "c_custkey"),
        "lineitem.l_orderkey": (t["lineitem"], "l_orderkey", t["orders"], "o_orderkey"),
        "lineitem.l_suppkey": (t["lineitem"], "l_suppkey", t["supplier"], "s_suppkey"),
        "lineitem.l_partkey": (t["lineitem"], "l_partkey", t["part"], "p_partkey"),
        "customer.c_nationkey": (t["customer"], "c_nationkey", t["nation"], "n_nationkey"),
        "supplier.s_nationkey": (t["supplier"], "s_nationkey", t["nation"], "n_nationkey"),
        "events.user_id": (t["events"], "user_id", t["customer"], "c_custkey"),
        "orders.o_custkey->building_customer": (t["orders"], "o_custkey", building, "c_custkey"),
    }
    return constraint_report({}, fks)


@query("key_report", """
WITH li AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE l_orderkey END AS k1, CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_linenumber END AS k2,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN -l_suppkey ELSE l_suppkey END AS supp,
         CASE WHEN l_partkey % 13 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS part, 'o' || CAST(l_orderkey AS VARCHAR) AS ord FROM lineitem
), od AS (SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS ord FROM orders WHERE o_orderkey % 7 <> 0)
SELECT 'li.key' AS check_name, 'primary_key' AS kind, count(*) AS violations
FROM (SELECT k1, k2 FROM li GROUP BY k1, k2 HAVING count(*) > 1 OR k1 IS NULL OR k2 IS NULL)
UNION ALL SELECT 'li.supp', 'foreign_key', count(*) FROM li WHERE supp IS NOT NULL AND supp NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'li.part', 'foreign_key', count(*) FROM li WHERE part NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'li.ord', 'foreign_key', count(*) FROM li WHERE ord NOT IN (SELECT ord FROM od)
UNION ALL SELECT 'od.ord', 'primary_key', 0
""")
def key_report(spark, sf_dir):
    """Planted repeats, null keys and orphans of number and text keys, each table in one scan."""
    k, p = F.col("l_orderkey"), F.col("l_partkey")
    li = table(spark, sf_dir, "lineitem").select(
        F.when(k % 97 == 0, F.lit(1)).otherwise(k).alias("k1"), F.when(k % 97 != 0, F.col("l_linenumber")).alias("k2"),
        F.when(k % 5 != 0, F.when(k % 31 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))).alias("supp"),
        F.when(p % 13 == 0, p + 1_000_000_000).otherwise(p).alias("part"), F.concat(F.lit("o"), k.cast("string")).alias("ord"))
    od = table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("ord"))
    return constraint_report(
        {"li.key": (li, ["k1", "k2"]), "od.ord": (od, ["ord"])},
        {"li.supp": (li, "supp", table(spark, sf_dir, "supplier"), "s_suppkey"), "li.part": (li, "part", table(spark, sf_dir, "part"), "p_partkey"),
         "li.ord": (li, "ord", od, "ord")})


@query("scorer_rank", _with(_SQL_RANKING, """
final AS (SELECT * FROM ranking)
SELECT rang, id_joueur, nom, nationalite, nb_buts, nb_penaltys FROM final
"""))
def scorer_rank(spark, sf_dir):
    return supplier_ranking(spark, sf_dir)


_SQL_TEAM_RECORD = """
views AS (
  SELECT id_equipe_domicile AS id_equipe, score_domicile AS bp, score_exterieur AS bc FROM fact
  UNION ALL SELECT id_equipe_exterieur, score_exterieur, score_domicile FROM fact
),
agg AS (
  SELECT id_equipe, count(bp) AS nb_matchs,
         CAST(sum(CASE WHEN bp > bc THEN 1 ELSE 0 END) AS BIGINT) AS victoires,
         CAST(sum(CASE WHEN bp = bc THEN 1 ELSE 0 END) AS BIGINT) AS nuls,
         CAST(sum(CASE WHEN bp < bc THEN 1 ELSE 0 END) AS BIGINT) AS defaites,
         CAST(coalesce(sum(bp), 0) AS BIGINT) AS buts_marques,
         CAST(coalesce(sum(bc), 0) AS BIGINT) AS buts_encaisses
  FROM views WHERE id_equipe IS NOT NULL GROUP BY id_equipe
)
SELECT a.id_equipe, d.pays, d.confederation, a.nb_matchs, a.victoires, a.nuls, a.defaites,
       a.buts_marques, a.buts_encaisses, a.buts_marques - a.buts_encaisses AS difference_buts
FROM agg a LEFT JOIN dteam d ON a.id_equipe = d.id_equipe
"""


@query("team_record", _with(_SQL_TRADE, _SQL_DIMS, _SQL_FACT, _SQL_TEAM_RECORD))
def team_record(spark, sf_dir):
    """Flagship: trade fact → both roles → W/D/L and goals per team."""
    teams = dim_nation(spark, sf_dir)
    fact = trade_fact(spark, sf_dir, teams=teams)
    return marts.team_record(fact, teams)


_SQL_EDITION_STATS = """
agg AS (
  SELECT id_edition, count(l_orderkey) AS nb_matchs,
         CAST(coalesce(sum(score_domicile), 0) + coalesce(sum(score_exterieur), 0) AS BIGINT) AS nb_buts,
         avg(affluence) AS att
  FROM fact WHERE id_edition IS NOT NULL GROUP BY id_edition
)
SELECT a.id_edition, y.annee, a.nb_matchs, a.nb_buts,
       round_even(CAST(a.nb_buts AS DOUBLE) / CAST(a.nb_matchs AS DOUBLE) * CAST(100 AS DOUBLE), 0)
         / CAST(100 AS DOUBLE) AS moyenne_buts_par_match,
       CAST(round_even(a.att, 0) AS BIGINT) AS affluence_moyenne
FROM agg a LEFT JOIN dyear y ON a.id_edition = y.id_edition
"""


@query("edition_stats", _with(_SQL_TRADE, _SQL_DIMS, _SQL_FACT, _SQL_EDITION_STATS))
def edition_stats(spark, sf_dir):
    years = dim_year(spark, sf_dir)
    fact = trade_fact(spark, sf_dir, years=years)
    return marts.edition_stats(fact, years, match_id="l_orderkey", label_cols=("annee",))


@query("period_share", """
WITH p AS (SELECT nullif(event_type, 'error') AS periode, event_id FROM events),
c AS (SELECT periode, count(event_id) AS nb_buts FROM p WHERE periode IS NOT NULL GROUP BY periode)
SELECT periode, nb_buts,
       round_even(CAST(100 AS DOUBLE) * nb_buts / CAST((SELECT sum(nb_buts) FROM c) AS DOUBLE)
                  * CAST(10 AS DOUBLE), 0) / CAST(10 AS DOUBLE) AS pourcentage
FROM c
""")
def period_share(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("periode"))
    return marts.share_by_category(e, "periode", "event_id")


# --------------------------------------------------------------------------
# Served queries (Q*, U5, U6, O3, O4)
# --------------------------------------------------------------------------

@query("q_role_goals", _with(_SQL_TRADE, """
roles AS (
  SELECT home_team AS pays, year, home_score AS buts FROM trade
  UNION ALL
  SELECT away_team, year, away_score FROM trade
)
SELECT pays, CAST(year AS INTEGER) AS annee, CAST(coalesce(sum(buts), 0) AS BIGINT) AS total_buts FROM roles GROUP BY pays, year
"""))
def q_role_goals(spark, sf_dir):
    """Goals of every team in every edition over both roles."""
    sides = served(spark, sf_dir, ["dim_equipe", "fait_match"])
    both = role_union(sides.sql("SELECT * FROM fait_match"), [
        {"id_equipe": "id_equipe_domicile", "buts": "score_domicile"},
        {"id_equipe": "id_equipe_exterieur", "buts": "score_exterieur"}], keep=["annee"])
    named = lookup_join(both, sides.sql("SELECT id_equipe, pays FROM dim_equipe"), "id_equipe", "inner")
    return named.groupBy("pays", F.col("annee").cast("int").alias("annee")).agg(
        S.sum_or_zero("buts").cast("bigint").alias("total_buts"))


def served(spark: SparkSession, sf_dir: str, names: list[str]) -> ServedCatalog:
    """A served catalog over the trade model, holding only the listed views."""
    built: dict[str, DataFrame] = {}

    def once(name, make):
        def get(s):
            if name not in built:
                built[name] = make(s)
            return built[name]
        return get

    teams = once("teams", lambda s: dim_nation(s, sf_dir))
    years = once("years", lambda s: dim_year(s, sf_dir))
    fact = once("fact", lambda s: trade_fact(s, sf_dir, teams=teams(s), years=years(s)))
    builders = {
        "dim_equipe": teams,
        "dim_edition": years,
        "dim_joueur": lambda s: dim_supplier(s, sf_dir).drop("s_suppkey"),
        "fait_match": fact,
        "mart_classement_buteurs": lambda s: supplier_ranking(s, sf_dir),
        "mart_stats_equipe": lambda s: marts.team_record(fact(s), teams(s)),
        "mart_stats_edition": lambda s: marts.edition_stats(fact(s), years(s), match_id="l_orderkey",
                                                            label_cols=("annee",)),
    }
    return ServedCatalog(spark, {n: builders[n] for n in names})


@query("q_labels", "SELECT n_name AS pays FROM nation WHERE n_name IS NOT NULL")
def q_labels(spark, sf_dir):
    return served(spark, sf_dir, ["dim_equipe"]).sql(
        "SELECT pays FROM dim_equipe WHERE pays IS NOT NULL ORDER BY pays")


@query("q_topk", _with(_SQL_RANKING, """
x AS (SELECT 1)
SELECT nationalite, rang FROM ranking ORDER BY rang LIMIT 25 OFFSET 5
"""))
def q_topk(spark, sf_dir):
    """A page of the ranking."""
    return served(spark, sf_dir, ["mart_classement_buteurs"]).sql(
        "SELECT nationalite, rang FROM mart_classement_buteurs ORDER BY rang LIMIT 25 OFFSET 5")


@query("q_edition_listing", _with(_SQL_TRADE, _SQL_DIMS, _SQL_FACT, """
agg AS (
  SELECT id_edition, count(l_orderkey) AS nb_matchs,
         CAST(coalesce(sum(score_domicile), 0) + coalesce(sum(score_exterieur), 0) AS BIGINT) AS nb_buts
  FROM fact WHERE id_edition IS NOT NULL GROUP BY id_edition
)
SELECT y.annee, a.nb_matchs, a.nb_buts FROM agg a LEFT JOIN dyear y ON a.id_edition = y.id_edition
"""))
def q_edition_listing(spark, sf_dir):
    return served(spark, sf_dir, ["mart_stats_edition"]).sql(
        "SELECT annee, nb_matchs, nb_buts FROM mart_stats_edition ORDER BY annee DESC")


@query("q_table_counts", _with(_SQL_TRADE, """
x AS (SELECT 1)
SELECT 'dim_equipe' AS table_name, count(*) AS n_rows FROM nation
UNION ALL SELECT 'dim_edition', count(DISTINCT year(o_orderdate)) FROM orders
UNION ALL SELECT 'dim_joueur', count(*) FROM supplier
UNION ALL SELECT 'fait_match', count(*) FROM trade
"""))
def q_table_counts(spark, sf_dir):
    cat = served(spark, sf_dir, ["dim_equipe", "dim_edition", "dim_joueur", "fait_match"])
    return cat.sql("""
        SELECT 'dim_equipe' AS table_name, COUNT(*) AS n_rows FROM dim_equipe
        UNION ALL SELECT 'dim_edition', COUNT(*) FROM dim_edition
        UNION ALL SELECT 'dim_joueur', COUNT(*) FROM dim_joueur
        UNION ALL SELECT 'fait_match', COUNT(*) FROM fait_match""")


@query("q_cte_count", _with(_SQL_TRADE, """
per_year AS (SELECT year, count(*) AS n FROM trade GROUP BY year)
SELECT count(*) AS n_years, CAST(sum(n) AS BIGINT) AS n_matches, max(n) AS n_busiest FROM per_year
"""))
def q_cte_count(spark, sf_dir):
    """Chained common table expressions."""
    return served(spark, sf_dir, ["fait_match"]).sql("""
        WITH per_year AS (SELECT annee, count(1) AS n FROM fait_match GROUP BY annee),
             summary AS (SELECT count(1) AS n_years, sum(n) AS n_matches, max(n) AS n_busiest FROM per_year)
        SELECT n_years, n_matches, n_busiest FROM summary""")


@query("q_union", _with(_SQL_TRADE, """
u AS (SELECT 1 AS v FROM trade UNION ALL SELECT 2 AS v FROM trade)
SELECT v, count(*) AS n FROM u GROUP BY v
"""))
def q_union(spark, sf_dir):
    return served(spark, sf_dir, ["fait_match"]).sql(
        "SELECT v, COUNT(*) AS n FROM (SELECT 1 AS v FROM fait_match UNION ALL "
        "SELECT 2 AS v FROM fait_match) u GROUP BY v")


@query("q_union_distinct", _with(_SQL_TRADE, _SQL_DIMS, _SQL_FACT, """
x AS (SELECT 1)
SELECT 'home' AS role, id_equipe_domicile AS id_equipe FROM fact
UNION SELECT 'away', id_equipe_exterieur FROM fact
"""))
def q_union_distinct(spark, sf_dir):
    return served(spark, sf_dir, ["fait_match"]).sql(
        "SELECT 'home' AS role, id_equipe_domicile AS id_equipe FROM fait_match "
        "UNION SELECT 'away', id_equipe_exterieur FROM fait_match")


@query("q_intersect", _with(_SQL_RANKING, _SQL_DIMS, """
x AS (SELECT 1)
SELECT nationalite AS pays FROM ranking
INTERSECT SELECT pays FROM dteam WHERE confederation IN ('AMERICA', 'ASIA')
"""))
def q_intersect(spark, sf_dir):
    return served(spark, sf_dir, ["mart_classement_buteurs", "dim_equipe"]).sql(
        "SELECT nationalite AS pays FROM mart_classement_buteurs "
        "INTERSECT SELECT pays FROM dim_equipe WHERE confederation IN ('AMERICA', 'ASIA')")


@query("q_except", _with(_SQL_TRADE, _SQL_DIMS, _SQL_FACT, """
x AS (SELECT 1)
SELECT id_edition, id_equipe_domicile, id_equipe_exterieur FROM fact
EXCEPT SELECT id_edition, id_equipe_exterieur, id_equipe_domicile FROM fact
"""))
def q_except(spark, sf_dir):
    """Pairings of an edition that were only played one way round."""
    return served(spark, sf_dir, ["fait_match"]).sql(
        "SELECT id_edition, id_equipe_domicile, id_equipe_exterieur FROM fait_match "
        "EXCEPT SELECT id_edition, id_equipe_exterieur, id_equipe_domicile FROM fait_match")


# --------------------------------------------------------------------------
# Sources and sinks on data Spark derives from the driver tables (S*)
# --------------------------------------------------------------------------

@query("latest_partition", """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS ingest_date FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def latest_partition(spark, sf_dir):
    """Events written by day (dynamic overwrite), newest day read back."""
    root = scratch_path(spark, "events_by_day")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    (e.withColumn("ingest_date", F.to_date("ts"))
      .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
      .partitionBy("ingest_date").parquet(root))
    latest = read_latest(spark, root)
    return latest.select("event_id", "ts", "user_id", "event_type", "value",
                         F.col("ingest_date").cast("date").alias("ingest_date"))


@query("multiheader_flat", """
WITH t AS (
  SELECT r.r_name AS league, year(o.o_orderdate) AS season, n.n_name AS team,
         l.l_suppkey, l.l_quantity, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
), a AS (
  SELECT league, CAST(season AS BIGINT) AS season, team, count(DISTINCT l_suppkey) AS players_used,
         CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS performance_gls,
         CAST(sum(l_linenumber) AS BIGINT) AS performance_ast, count(*) AS n
  FROM t GROUP BY league, season, team
)
SELECT league, season, team, players_used, performance_gls, performance_ast,
       performance_gls + performance_ast AS performance_g_plus_a,
       round_even(CAST(performance_gls AS DOUBLE) / CAST(n AS DOUBLE) * CAST(100 AS DOUBLE), 0)
         / CAST(100 AS DOUBLE) AS per_90_minutes_gls,
       '/en/squads/' || lower(team) || '/' || CAST(season AS VARCHAR) AS url
FROM a
""")
def multiheader_flat(spark, sf_dir):
    """Per (region, year, nation) statistics written in the two-level header
    layout, then read back, flattened, typed and finished by the silver job."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_linenumber")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region")
    t = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    t = lookup_join(t, s, t["l_suppkey"] == s["s_suppkey"], "inner")
    t = lookup_join(t, n, t["s_nationkey"] == n["n_nationkey"], "inner")
    t = lookup_join(t, r, t["n_regionkey"] == r["r_regionkey"], "inner")
    a = t.groupBy(F.col("r_name").alias("league"), F.year("o_orderdate").alias("season"),
                  F.col("n_name").alias("team")).agg(
        F.count_distinct("l_suppkey").alias("players_used"),
        F.sum(F.col("l_quantity").cast("int")).alias("gls"),
        F.sum("l_linenumber").alias("ast"), F.count(F.lit(1)).alias("n"))
    a = a.select("league", "season", "team", "players_used", "gls", "ast",
                 (F.col("gls") + F.col("ast")).alias("ga"),
                 S.round_half_even(F.col("gls") / F.col("n"), 2).alias("gls90"),
                 F.concat(F.lit("/en/squads/"), F.lower("team"), F.lit("/"),
                          F.col("season").cast("string")).alias("url"))
    path = scratch_path(spark, "team_stats_layout")
    groups = [("players_used", ""), ("Performance", "Gls"), ("Performance", "Ast"),
              ("Performance", "G+A"), ("Per 90 Minutes", "Gls"), ("url", "")]
    write_multiheader_csv(a, path, groups, ["league", "season", "team"])
    flat = read_multiheader_csv(spark, path, n_index=3, text=None)
    return silver.transform_flat(flat, mapping={})


@query("load_audit", """
SELECT 'region' AS table_name, count(*) AS n_rows FROM region
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events
""")
def load_audit(spark, sf_dir):
    """Dated partition writes of every input table with row counts observed
    during the write."""
    names = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events"]
    root = scratch_path(spark, "silver_audit")
    audit = audited_writes(spark, {n: table(spark, sf_dir, n) for n in names}, root, "2024-01-31")
    return audit.select("table_name", "n_rows")


# The queries over the silver jobs and gold builders register themselves.
from . import layer_queries, source_queries  # noqa: E402, F401
