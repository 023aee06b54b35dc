"""Conformance queries that run the silver jobs and gold builders themselves.

Raw all-string frames, as the CSV reader gives them, are formed from the
driver tables: a match is an order (home team: the customer's nation; away
team, scores, venue and packed goal cells from its numbers).  They hold what
raw files hold: unreadable dates, missing teams, venues and scorers, blanks,
stoppage time, several rows of one venue.  Each oracle computes the expected
rows straight from the tables, without any text in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import gold, silver
from .conformance import query, table

# The oracle's view of the raw matches, typed.
_SQL_MATCHES = """
mt AS (
  SELECT o.o_orderkey AS k, CAST(year(o.o_orderdate) AS BIGINT) AS year,
         CASE WHEN o.o_orderkey % 40 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS match_date,
         CASE WHEN o.o_orderkey % 50 = 1 THEN NULL ELSE h.n_name END AS home_team,
         a.n_name AS away_team, o.o_orderkey % 6 AS hs, o.o_orderkey % 4 AS aws,
         CASE WHEN o.o_orderkey % 33 = 2 THEN NULL ELSE 'Stadium ' || CAST(o.o_custkey % 40 AS VARCHAR) END AS venue_name,
         CASE WHEN o.o_orderkey % 33 = 2 THEN NULL WHEN o.o_custkey % 40 = 7 THEN NULL
              ELSE 'City ' || CAST(o.o_custkey % 40 % 9 AS VARCHAR) END AS venue_city,
         'Host ' || CAST(o.o_orderkey % 5 AS VARCHAR) AS host
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation h ON c.c_nationkey = h.n_nationkey
  JOIN nation a ON (o.o_orderkey // 3) % 25 = a.n_nationkey
),
m AS (
  SELECT *, substr(md5(concat_ws('|', coalesce(CAST(match_date AS VARCHAR), 'None'), coalesce(home_team, 'None'),
                                 coalesce(away_team, 'None'))), 1, 12) AS match_key FROM mt
)"""
_SQL_GOALS = """
shot AS (
  SELECT m.*, 'home' AS side, 'open_play' AS goal_type, 0 AS source_ordinal, unnest(range(0, hs)) AS i FROM m
  UNION ALL SELECT m.*, 'away', 'open_play', 1, unnest(range(0, aws)) FROM m
  UNION ALL SELECT m.*, 'home', 'penalty', 2, 0 FROM m WHERE k % 7 = 0
  UNION ALL SELECT m.*, 'away', 'own_goal', 5, 0 FROM m WHERE k % 11 = 0
),
g AS (
  SELECT match_key, year, match_date, CASE side WHEN 'home' THEN home_team ELSE away_team END AS team,
         CASE side WHEN 'home' THEN away_team ELSE home_team END AS opponent, side,
         CASE WHEN (k + i) % 29 = 0 THEN NULL ELSE 'Player ' || CAST((k * 7 + i) % 500 AS VARCHAR) END AS scorer,
         goal_type, goal_type = 'penalty' AS is_penalty, goal_type = 'own_goal' AS is_own_goal,
         CASE WHEN (k + i) % 31 = 0 THEN NULL ELSE CAST((k * 13 + i * 17) % 120 + 1 AS BIGINT) END AS minute,
         CASE WHEN (k + i) % 31 = 0 THEN NULL ELSE CAST(CASE WHEN (k + i) % 5 = 0 THEN i + 1 ELSE 0 END AS BIGINT) END AS stoppage_time,
         source_ordinal, i AS position, k
  FROM shot
),
goal AS (
  SELECT *, minute + stoppage_time AS minute_absolute,
         CASE WHEN minute IS NULL THEN NULL WHEN minute <= 45 THEN '1re mi-temps'
              WHEN minute <= 90 THEN '2e mi-temps' ELSE 'prolongation' END AS period
  FROM g
)"""
_SQL_EDITIONS = """
ed AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year, 'Host ' || CAST(year(o_orderdate) % 5 AS VARCHAR) AS host,
         CAST(year(o_orderdate) % 20 AS BIGINT) AS teams, 'NATION_' || CAST(year(o_orderdate) % 25 AS VARCHAR) AS champion,
         CAST(NULL AS VARCHAR) AS runner_up, 'Top-Name ' || CAST(max(o_orderkey) AS VARCHAR) AS top_scorer,
         CAST(count(*) % 30 AS BIGINT) AS top_scorer_goals, count(*) * 1000 AS attendance_total,
         CAST(NULL AS BIGINT) AS attendance_avg, count(*) AS matches
  FROM orders GROUP BY year(o_orderdate)
)"""
_SQL_RANKING_RAW = """
rk AS (
  SELECT CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE DATE '2020-01-01' + CAST(c_custkey % 400 AS INTEGER) END AS snapshot_date,
         n_name AS team, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'T' || CAST(c_nationkey AS VARCHAR) || 'x' || CAST(c_custkey % 7 AS VARCHAR) END AS team_code,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'C' || CAST(c_custkey % 6 AS VARCHAR) END AS confederation,
         CAST(c_custkey AS BIGINT) AS rank, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey + 1 AS BIGINT) END AS previous_rank,
         CAST(c_custkey AS DOUBLE) / 4 AS points, CAST(NULL AS DOUBLE) AS previous_points
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""
_SQL_PLAYERS = """
ps AS (
  SELECT 'Player ' || CAST(s_suppkey % 300 AS VARCHAR) AS player, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'P' || CAST(s_suppkey % 5 AS VARCHAR) END AS pos,
         n_name AS nation, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 2000 + s_suppkey % 7 END AS season, 'NATION_' || CAST(s_suppkey % 25 AS VARCHAR) AS team
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""
_SQL_DIMS = """
ddim_edition AS (
  SELECT CAST(row_number() OVER (ORDER BY year, host, champion) AS INTEGER) AS id_edition, CAST(year AS INTEGER) AS annee, host AS pays_hote,
         CAST(teams AS INTEGER) AS nb_equipes, champion, runner_up AS finaliste, top_scorer AS meilleur_buteur,
         CAST(top_scorer_goals AS INTEGER) AS meilleur_buteur_buts, attendance_total AS affluence_totale,
         CAST(attendance_avg AS INTEGER) AS affluence_moyenne, CAST(matches AS INTEGER) AS nb_matchs FROM ed
),
labels AS (
  SELECT home_team AS pays FROM m UNION SELECT away_team FROM m UNION SELECT host FROM m UNION SELECT team FROM goal
  UNION SELECT opponent FROM goal UNION SELECT host FROM ed UNION SELECT champion FROM ed UNION SELECT runner_up FROM ed UNION SELECT team FROM rk
),
last_code AS (SELECT team, team_code FROM rk WHERE team_code IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY team ORDER BY snapshot_date DESC NULLS FIRST, rank DESC) = 1),
last_conf AS (SELECT team, confederation FROM rk WHERE confederation IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY team ORDER BY snapshot_date DESC NULLS FIRST, rank DESC) = 1),
ddim_equipe AS (
  SELECT CAST(row_number() OVER (ORDER BY pays) AS INTEGER) AS id_equipe, pays, confederation, team_code AS code_pays
  FROM labels LEFT JOIN last_code ON last_code.team = pays LEFT JOIN last_conf ON last_conf.team = pays WHERE pays IS NOT NULL
),
stadium AS (
  SELECT venue_name, coalesce(venue_city, '') AS venue_city, host FROM m WHERE venue_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY venue_name, coalesce(venue_city, '') ORDER BY match_date NULLS LAST, match_key, host) = 1
),
ddim_stade AS (
  SELECT CAST(row_number() OVER (ORDER BY venue_name, venue_city) AS INTEGER) AS id_stade, venue_name AS nom_stade, venue_city AS ville, host AS pays_hote FROM stadium
),
known AS (
  SELECT player AS nom, pos AS poste, nation AS nationalite FROM ps
  QUALIFY row_number() OVER (PARTITION BY player ORDER BY season NULLS LAST, team, pos NULLS LAST, nation) = 1
),
players AS (
  SELECT * FROM known UNION ALL SELECT DISTINCT scorer, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM goal
  WHERE scorer IS NOT NULL AND scorer NOT IN (SELECT nom FROM known)
),
ddim_joueur AS (SELECT CAST(row_number() OVER (ORDER BY nom) AS INTEGER) AS id_joueur, nom, poste, nationalite FROM players)"""


def _sql(*parts: str) -> str:
    return "WITH " + ",".join(parts[:-1]) + parts[-1]


_ALL = (_SQL_MATCHES, _SQL_GOALS, _SQL_EDITIONS, _SQL_RANKING_RAW, _SQL_PLAYERS, _SQL_DIMS)


def _text(c) -> F.Column:
    return c.cast("string")


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    home = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("h"))
    away = n.select(F.col("n_nationkey").alias("ak"), F.col("n_name").alias("a"))
    k = F.col("o_orderkey")
    d = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(home, "c_nationkey") \
         .withColumn("ak", F.floor(k / 3) % 25).join(away, "ak")
    place = F.col("o_custkey") % 40
    city = F.when(place == 7, F.lit("")).otherwise(F.concat(F.lit(", City "), _text(place % 9)))

    def cell(count, mark=""):
        def goal(i):
            scorer = F.when((k + i) % 29 == 0, F.lit(" ")).otherwise(F.concat(F.lit("Player "), _text((k * 7 + i) % 500), F.lit(mark)))
            added = F.when((k + i) % 5 == 0, F.concat(F.lit("+"), _text(i + 1))).otherwise(F.lit(""))
            minute = F.when((k + i) % 31 == 0, F.lit("?")).otherwise(F.concat(_text((k * 13 + i * 17) % 120 + 1), added))
            return F.concat(F.lit(" "), scorer, F.lit(" · "), minute)
        return F.when(count > 0, F.array_join(F.transform(F.sequence(F.lit(0), count - 1), goal), "|"))

    return d.select(
        k, _text(F.year("o_orderdate")).alias("Year"),
        F.when(k % 40 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Date"),
        F.lit(" Group ").alias("Round"),
        F.when(k % 50 != 1, F.concat(F.lit("  "), F.col("h"), F.lit(" "))).alias("home_team"), F.col("a").alias("away_team"),
        _text(k % 6).alias("home_score"), F.concat(_text(k % 4), F.lit(".0")).alias("away_score"),
        _text((k % 10) / 4).alias("home_xg"), F.lit("n/a").alias("away_xg"),
        F.when(k % 13 == 0, F.lit("4")).alias("home_penalty"), F.when(k % 13 == 0, F.lit("3")).alias("away_penalty"),
        _text(k * 10).alias("Attendance"),
        F.when(k % 33 != 2, F.concat(F.lit("Stadium "), _text(place), city)).alias("Venue"),
        F.concat(F.lit("Host "), _text(k % 5)).alias("Host"), F.lit(None).cast("string").alias("Referee"),
        cell((k % 6).cast("int")).alias("home_goal"), cell((k % 4).cast("int")).alias("away_goal"),
        cell(F.when(k % 7 == 0, 1).otherwise(0), " (P)").alias("home_penalty_goal"), F.lit(None).cast("string").alias("away_penalty_goal"),
        F.lit(" ").alias("home_own_goal"), cell(F.when(k % 11 == 0, 1).otherwise(0)).alias("away_own_goal"))


def raw_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(
        F.max("o_orderkey").alias("k"), F.count(F.lit(1)).alias("n"))
    y = F.col("y")
    return o.select(
        _text(y).alias("Year"), F.concat(F.lit(" Host "), _text(y % 5)).alias("Host"), F.concat(_text(y % 20), F.lit(".0")).alias("Teams"),
        F.concat(F.lit("NATION_"), _text(y % 25)).alias("Champion"), F.lit(None).cast("string").alias("Runner-Up"),
        F.concat(F.lit("Top-Name "), _text(F.col("k")), F.lit(" - "), _text(F.col("n") % 30)).alias("TopScorrer"),
        _text(F.col("n") * 1000).alias("Attendance"), F.lit("12d").alias("AttendanceAvg"), _text(F.col("n")).alias("Matches"))


def raw_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (k % 400).cast("int"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(k % 17 == 0, F.lit("ranking.csv")).otherwise(F.concat(F.lit("ranking_"), _text(day), F.lit(".csv"))).alias("source_file"),
        F.concat(F.col("n_name"), F.lit("  ")).alias("team"),
        F.when(k % 3 != 0, F.concat(F.lit(" T"), _text(F.col("c_nationkey")), F.lit("x"), _text(k % 7))).alias("team_code"),
        F.when(k % 4 != 0, F.concat(F.lit("C"), _text(k % 6))).alias("association"),
        _text(k).alias("rank"), F.when(k % 5 != 0, F.concat(_text(k + 1), F.lit(".0"))).alias("previous_rank"),
        _text(k / 4).alias("points"), F.lit("0x1p3").alias("previous_points"))


def raw_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("event_id"), F.date_format("ts", "H:mm")
    return table(spark, sf_dir, "events").select(
        _text(F.year("ts")).alias("Year"), F.col("event_type").alias("Round"), F.date_format("ts", "yyyy-M-d").alias("Date"),
        F.when(k % 7 == 0, F.lit("tbd")).when(k % 2 == 0, F.concat(t, F.lit(" (23:05)"))).otherwise(t).alias("Time"),
        F.concat(F.lit("USA "), F.lit("")).alias("home_team"), F.concat(F.lit("Team "), _text(F.col("user_id"))).alias("away_team"),
        F.lit(" R ").alias("Referee"), k)


_SQL_KICKOFF = """
  CAST(ts AS DATE) AS match_date, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts, '%H:%M') END AS kickoff_local_time,
  CASE WHEN event_id % 7 <> 0 AND event_id % 2 = 0 THEN '23:05' END AS kickoff_other_time,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('minute', ts) END AS kickoff_datetime_local"""


def _silver(spark, sf_dir):
    raw = raw_matches(spark, sf_dir)
    return silver.transform_matches(raw, {}), silver.transform_goals(raw, {}, keep_order_columns=True)


@query("layer_matches", _sql(_SQL_MATCHES, """
SELECT match_key, year, match_date, 'Group' AS round, home_team, away_team, CAST(hs AS BIGINT) AS home_score, CAST(aws AS BIGINT) AS away_score,
       (k % 10) / 4.0 AS home_xg, CAST(NULL AS DOUBLE) AS away_xg, CASE WHEN k % 13 = 0 THEN CAST(4 AS BIGINT) END AS penalty_home,
       CASE WHEN k % 13 = 0 THEN CAST(3 AS BIGINT) END AS penalty_away, k % 13 = 0 AS went_to_penalties, k * 10 AS attendance,
       venue_name, venue_city, host, CAST(NULL AS VARCHAR) AS referee
FROM m"""))
def layer_matches(spark, sf_dir):
    """TJ1 over raw match rows."""
    return _silver(spark, sf_dir)[0]


@query("layer_goals", _sql(_SQL_MATCHES, _SQL_GOALS, """
SELECT match_key, year, match_date, team, opponent, side, scorer, goal_type, is_penalty, is_own_goal, minute, stoppage_time, minute_absolute, period FROM goal"""))
def layer_goals(spark, sf_dir):
    """TJ2 over raw match rows: null scorers and minutes, blank cells."""
    return silver.transform_goals(raw_matches(spark, sf_dir), {})


@query("layer_editions", _sql(_SQL_EDITIONS, "SELECT * FROM ed"))
def layer_editions(spark, sf_dir):
    """TJ3."""
    return silver.transform_editions(raw_editions(spark, sf_dir), {})


@query("layer_ranking", _sql(_SQL_RANKING_RAW, "SELECT * FROM rk"))
def layer_ranking(spark, sf_dir):
    """TJ4: snapshot dates from file names, numbers that are none."""
    return silver.transform_fifa_ranking(raw_ranking(spark, sf_dir), mapping={})


@query("layer_schedule", f"""
SELECT CAST(year(ts) AS BIGINT) AS year, event_type AS round, {_SQL_KICKOFF}, 'United States' AS home_team,
       'Team ' || CAST(user_id AS VARCHAR) AS away_team, 'R' AS referee FROM events""")
def layer_schedule(spark, sf_dir):
    """TJ5: one-digit dates, kick-off texts, canonical labels."""
    return silver.transform_schedule_2026(raw_schedule(spark, sf_dir))


@query("layer_fbref", f"""
SELECT CAST(year(ts) AS BIGINT) AS season, event_type AS round, CAST(event_id % 40 AS BIGINT) AS week, {_SQL_KICKOFF}, 'United States' AS home_team,
       'Team ' || CAST(user_id AS VARCHAR) AS away_team, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 5 AS BIGINT) END AS home_score,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 4 AS BIGINT) END AS away_score, CAST(event_id AS BIGINT) AS attendance,
       event_id % 6 = 0 AS neutral_site, 'Ground ' || CAST(event_id % 9 AS VARCHAR) AS venue, 'R' AS referee, CAST(event_id AS VARCHAR) AS game_id
FROM events""")
def layer_fbref(spark, sf_dir):
    """TJ6: scores with shoot-outs, neutral sites."""
    k = F.col("event_id")
    raw = raw_schedule(spark, sf_dir).select(
        F.col("Year").alias("season"), F.col("Round").alias("round"), _text(k % 40).alias("week"), F.col("Date").alias("date"),
        F.col("Time").alias("time"), "home_team", "away_team",
        F.when(k % 3 == 0, F.lit("postponed")).otherwise(F.concat(F.lit("(4) "), _text(k % 5), F.lit("–"), _text(k % 4), F.lit(" (3)"))).alias("score"),
        _text(k).alias("attendance"),
        F.concat(F.lit("Ground "), _text(k % 9), F.when(k % 6 == 0, F.lit(" (Neutral Site)")).otherwise(F.lit(""))).alias("venue"),
        F.col("Referee").alias("referee"), _text(k).alias("game_id"))
    return silver.transform_fbref_schedule(raw)


def _players(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    raw = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("Player "), _text(k % 300), F.lit(" ")).alias("player"), F.when(k % 4 != 0, F.concat(F.lit("P"), _text(k % 5))).alias("pos"),
        F.col("n_name").alias("nation"), F.when(k % 9 != 0, _text(2000 + k % 7)).alias("season"), F.concat(F.lit("NATION_"), _text(k % 25)).alias("team"))
    return silver.transform_flat(raw, {})


def _written(df: DataFrame, name: str) -> DataFrame:
    """The silver table as the gold builders read it: written once, so that no builder parses it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dims(spark, sf_dir) -> dict[str, DataFrame]:
    m, g = _silver(spark, sf_dir)
    m, g = _written(m, "silver-matches"), _written(g, "silver-goals")
    ed, rk = layer_editions(spark, sf_dir), layer_ranking(spark, sf_dir)
    return {"matches": m, "goals": g, "dim_edition": lambda: gold.build_dim_edition(ed), "dim_equipe": lambda: gold.build_dim_equipe(m, g, ed, rk),
            "dim_stade": lambda: gold.build_dim_stade(m), "dim_joueur": lambda: gold.build_dim_joueur(_players(spark, sf_dir), g)}


@query("layer_dim_edition", _sql(_SQL_EDITIONS, """
SELECT CAST(row_number() OVER (ORDER BY year, host, champion) AS INTEGER) AS id_edition, CAST(year AS INTEGER) AS annee, host AS pays_hote,
       CAST(teams AS INTEGER) AS nb_equipes, champion, runner_up AS finaliste, top_scorer AS meilleur_buteur,
       CAST(top_scorer_goals AS INTEGER) AS meilleur_buteur_buts, attendance_total AS affluence_totale,
       CAST(attendance_avg AS INTEGER) AS affluence_moyenne, CAST(matches AS INTEGER) AS nb_matchs FROM ed"""))
def layer_dim_edition(spark, sf_dir):
    """D1."""
    return _dims(spark, sf_dir)["dim_edition"]()


@query("layer_dim_equipe", _sql(*_ALL, "SELECT * FROM ddim_equipe"))
def layer_dim_equipe(spark, sf_dir):
    """Labels of nine columns, last known attributes with undated snapshots last."""
    return _dims(spark, sf_dir)["dim_equipe"]()


@query("layer_dim_stade", _sql(*_ALL, "SELECT * FROM ddim_stade"))
def layer_dim_stade(spark, sf_dir):
    """D3: the first host of each venue, undated matches last."""
    return _dims(spark, sf_dir)["dim_stade"]()


@query("layer_dim_joueur", _sql(*_ALL, "SELECT * FROM ddim_joueur"))
def layer_dim_joueur(spark, sf_dir):
    """Known players, then scorers nobody lists."""
    return _dims(spark, sf_dir)["dim_joueur"]()


@query("layer_fait_match", _sql(*_ALL, """
SELECT match_key AS id_match, e.id_edition, h.id_equipe AS id_equipe_domicile, a.id_equipe AS id_equipe_exterieur, s.id_stade, match_date AS date_match,
       CAST(year AS INTEGER) AS annee, 'Group' AS phase, CAST(hs AS INTEGER) AS score_domicile, CAST(aws AS INTEGER) AS score_exterieur,
       (k % 10) / 4.0 AS xg_domicile, CAST(NULL AS DOUBLE) AS xg_exterieur, CASE WHEN k % 13 = 0 THEN CAST(4 AS INTEGER) END AS penalty_domicile,
       CASE WHEN k % 13 = 0 THEN CAST(3 AS INTEGER) END AS penalty_exterieur, k % 13 = 0 AS seance_tirs_au_but, k * 10 AS affluence
FROM m LEFT JOIN ddim_edition e ON e.annee = m.year LEFT JOIN ddim_equipe h ON h.pays = home_team LEFT JOIN ddim_equipe a ON a.pays = away_team
LEFT JOIN ddim_stade s ON s.nom_stade = venue_name AND s.ville = coalesce(venue_city, '')"""))
def layer_fait_match(spark, sf_dir):
    """F1 over the built dimensions."""
    t = _dims(spark, sf_dir)
    return gold.build_fait_match(t["matches"], t["dim_edition"](), t["dim_equipe"](), t["dim_stade"]())


@query("layer_fait_but", _sql(*_ALL, """
SELECT row_number() OVER (ORDER BY match_key, minute_absolute NULLS LAST, source_ordinal, position, j.id_joueur NULLS LAST, q.id_equipe NULLS LAST,
                          minute NULLS LAST, stoppage_time NULLS LAST, period NULLS LAST, goal_type, is_penalty, is_own_goal) AS id_but,
       match_key AS id_match, j.id_joueur, q.id_equipe, CAST(minute AS INTEGER) AS minute, CAST(stoppage_time AS INTEGER) AS temps_additionnel,
       CAST(minute_absolute AS INTEGER) AS minute_absolue, period AS periode, goal_type AS type_but, is_penalty AS est_penalty, is_own_goal AS est_csc
FROM goal LEFT JOIN ddim_joueur j ON j.nom = scorer LEFT JOIN ddim_equipe q ON q.pays = goal.team"""))
def layer_fait_but(spark, sf_dir):
    """F2 over the built dimensions, with its dense key in the goals' order."""
    t = _dims(spark, sf_dir)
    return gold.build_fait_but(t["goals"], t["dim_joueur"](), t["dim_equipe"]())
