"""Silver table jobs: raw string columns → typed, canonical tables.

Every job is a pure ``DataFrame → DataFrame`` function over an all-string raw
frame (as produced by :func:`strata.sources.csv.read_raw_csv`); I/O lives in
:mod:`strata.sources`.  No Python UDF is used: each cell parser is a Column
expression from :mod:`strata.functions`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as S
from ..operators import explode_with_position, unpivot_tagged

# Canonical team labels (source label → canonical label).
TEAM_NAME_MAP = {
    "Korea Republic": "South Korea",
    "Korea DPR": "North Korea",
    "IR Iran": "Iran",
    "Iran": "Iran",
    "China PR": "China",
    "USA": "United States",
    "United States": "United States",
    "Czechia": "Czech Republic",
    "West Germany": "Germany",
    "Soviet Union": "Russia",
    "FR Yugoslavia": "Serbia",
    "Turkiye": "Turkey",
    "Türkiye": "Turkey",
    "Republic of Ireland": "Ireland",
    "Bosnia and Herzegovina": "Bosnia and Herzegovina",
}

# Packed goal columns of a match row, with the side credited and
# the kind of goal, in this order.
GOAL_SOURCES = [
    ("home_goal", {"side": "home", "goal_type": "open_play"}),
    ("away_goal", {"side": "away", "goal_type": "open_play"}),
    ("home_penalty_goal", {"side": "home", "goal_type": "penalty"}),
    ("away_penalty_goal", {"side": "away", "goal_type": "penalty"}),
    ("home_own_goal", {"side": "home", "goal_type": "own_goal"}),
    ("away_own_goal", {"side": "away", "goal_type": "own_goal"}),
]


def team(c, mapping=None):
    return S.canonical_label(c, TEAM_NAME_MAP if mapping is None else mapping)


def _labels(mapping):
    return TEAM_NAME_MAP if mapping is None else mapping


def transform_matches(df: DataFrame, mapping=None) -> DataFrame:
    """One typed row per match, keyed by the md5 content key."""
    # Each text is stripped or collapsed once: a column of its own projection is not computed again at each use.
    numbers = ["Year", "Date", "home_score", "away_score", "home_xg", "away_xg", "home_penalty", "away_penalty", "Attendance", "Venue", "Round", "Referee"]
    df = df.select(*[S.strip_ws(F.col(c).cast("string")).alias(c) for c in numbers], *[S.collapse_ws(c).alias(c) for c in ("home_team", "away_team", "Host")])
    venue_name, venue_city = S.rsplit_last("Venue", ",")
    labels = _labels(mapping)
    out = df.select(
        S.to_long("Year", stripped=True).alias("year"),
        S.to_date_coerce("Date", stripped=True).alias("match_date"),
        F.col("Round").alias("round"),
        S.map_label("home_team", labels).alias("home_team"),
        S.map_label("away_team", labels).alias("away_team"),
        S.to_long("home_score", stripped=True).alias("home_score"),
        S.to_long("away_score", stripped=True).alias("away_score"),
        S.to_double("home_xg", stripped=True).alias("home_xg"),
        S.to_double("away_xg", stripped=True).alias("away_xg"),
        S.to_long("home_penalty", stripped=True).alias("penalty_home"),
        S.to_long("away_penalty", stripped=True).alias("penalty_away"),
        S.to_long("Attendance", stripped=True).alias("attendance"),
        venue_name.alias("venue_name"),
        venue_city.alias("venue_city"),
        S.map_label("Host", labels).alias("host"),
        F.col("Referee").alias("referee"),
    )
    out = out.withColumn("went_to_penalties", S.both_present("penalty_home", "penalty_away"))
    key = S.row_key("match_date", "home_team", "away_team").alias("match_key")
    cols = ["year", "match_date", "round", "home_team", "away_team", "home_score",
            "away_score", "home_xg", "away_xg", "penalty_home", "penalty_away",
            "went_to_penalties", "attendance", "venue_name", "venue_city", "host", "referee"]
    return out.select(key, *cols)


def explode_goals(df: DataFrame, home: str, away: str, match_date: str, year: str,
                  sources=GOAL_SOURCES) -> DataFrame:
    """Packed goal cells of typed match rows → one row per goal.

    ``df`` carries canonical ``home``/``away`` labels, a DATE ``match_date``
    and a numeric ``year``, plus any of the packed columns in ``sources``
    (absent ones are skipped).  ``source_ordinal`` and ``position`` are kept
    for a stable order.
    """
    keyed = df.withColumn("match_key", S.row_key(match_date, home, away))
    keep = ["match_key", year, match_date, home, away]
    long = unpivot_tagged(keyed, sources, "cell", keep, skip_null=True)
    chunks = explode_with_position(long, S.goal_chunks("cell"),
                                   [*keep, "source_ordinal", "side", "goal_type"], "position", "raw_chunk")
    chunks = chunks.withColumn("chunk", S.strip_ws("raw_chunk"))
    # Flat columns, a projection a step: the fields of a struct would be computed again at each use.
    tags = [*keep, "source_ordinal", "side", "goal_type", "position"]
    g = S.parse_goal_chunk("chunk")
    goals = chunks.where(F.col("chunk") != "").select(
        *tags, g["scorer"].alias("scorer"), F.split(S.strip_ws(g["minute_token"]), r"\+").alias("minute_parts"))
    minute = S.minute_of_parts("minute_parts")
    goals = goals.select(*tags, "scorer", *[minute[c].alias(c) for c in ("minute", "stoppage_time", "minute_absolute")])
    is_home = F.col("side") == "home"
    return goals.select(
        "match_key",
        F.col(year).alias("year"),
        F.col(match_date).alias("match_date"),
        F.when(is_home, F.col(home)).otherwise(F.col(away)).alias("team"),
        F.when(is_home, F.col(away)).otherwise(F.col(home)).alias("opponent"),
        "side",
        S.empty_to_null("scorer").alias("scorer"),
        "goal_type",
        (F.col("goal_type") == "penalty").alias("is_penalty"),
        (F.col("goal_type") == "own_goal").alias("is_own_goal"),
        "minute", "stoppage_time", "minute_absolute",
        S.period_of_minute("minute").alias("period"),
        "source_ordinal", "position",
    )


GOAL_COLUMNS = ["match_key", "year", "match_date", "team", "opponent", "side", "scorer",
                "goal_type", "is_penalty", "is_own_goal", "minute", "stoppage_time",
                "minute_absolute", "period"]

# Order of goals inside the silver table and of ``id_but`` in gold: by match,
# then minute (nulls last), then the packed column and the position in it.
def goal_order(match_key: str = "match_key", minute_absolute: str = "minute_absolute"):
    return [match_key, minute_absolute, "source_ordinal", "position"]


def transform_goals(df: DataFrame, mapping=None, keep_order_columns: bool = False) -> DataFrame:
    """One row per goal from the packed cells of the raw match rows."""
    m = _labels(mapping)
    norm = df.select("*", S.collapse_ws("home_team").alias("__hn"), S.collapse_ws("away_team").alias("__an"),
                     *[S.strip_ws(F.col(c).cast("string")).alias(f"__s{c}") for c in ("Date", "Year")])
    typed = norm.select(
        "*",
        S.to_date_coerce("__sDate", stripped=True).alias("__date"),
        S.map_label("__hn", m).alias("__home"),
        S.map_label("__an", m).alias("__away"),
        S.to_long("__sYear", stripped=True).alias("__year"),
    )
    goals = explode_goals(typed, "__home", "__away", "__date", "__year")
    return goals if keep_order_columns else goals.select(*GOAL_COLUMNS)


def transform_editions(df: DataFrame, mapping=None) -> DataFrame:
    name, goals = S.rsplit_last("TopScorrer", "-")
    return df.select(
        S.to_long("Year").alias("year"),
        team("Host", mapping).alias("host"),
        S.to_long("Teams").alias("teams"),
        team("Champion", mapping).alias("champion"),
        team("Runner-Up", mapping).alias("runner_up"),
        name.alias("top_scorer"),
        S.to_long(goals).alias("top_scorer_goals"),
        S.to_long("Attendance").alias("attendance_total"),
        S.to_long("AttendanceAvg").alias("attendance_avg"),
        S.to_long("Matches").alias("matches"),
    )


RANKING_COLUMNS = ["snapshot_date", "team", "team_code", "confederation", "rank",
                   "previous_rank", "points", "previous_points"]


def transform_fifa_ranking(df: DataFrame, file_name_col: str = "source_file", mapping=None) -> DataFrame:
    """Ranking snapshots (already unioned by name) → long ranking table.

    The snapshot date is read from the file name; columns present in only some
    snapshots (``rated_matches``) are dropped.
    """
    return df.select(
        S.snapshot_date_from_name(file_name_col).alias("snapshot_date"),
        team("team", mapping).alias("team"),
        S.strip_ws("team_code").alias("team_code"),
        S.strip_ws("association").alias("confederation"),
        S.to_long("rank").alias("rank"),
        S.to_long("previous_rank").alias("previous_rank"),
        S.to_double("points").alias("points"),
        S.to_double("previous_points").alias("previous_points"),
    )


def _kickoff_columns(date_col: str, time_col: str):
    local, other = S.parse_kickoff(time_col)
    return [
        S.to_date_coerce(date_col).alias("match_date"),
        local.alias("kickoff_local_time"),
        other.alias("kickoff_other_time"),
        S.local_timestamp(date_col, local).alias("kickoff_datetime_local"),
    ]


def transform_schedule_2026(df: DataFrame, mapping=None) -> DataFrame:
    return df.select(
        S.to_long("Year").alias("year"),
        S.strip_ws("Round").alias("round"),
        *_kickoff_columns("Date", "Time"),
        team("home_team", mapping).alias("home_team"),
        team("away_team", mapping).alias("away_team"),
        S.strip_ws("Referee").alias("referee"),
    )


def transform_fbref_schedule(df: DataFrame, mapping=None) -> DataFrame:
    season = S.to_long("season") if "season" in df.columns else F.lit(None).cast("bigint")
    home_s, away_s = S.split_score("score")
    neutral, venue = S.flag_and_strip(S.strip_ws("venue"))
    return df.select(
        season.alias("season"),
        S.strip_ws("round").alias("round"),
        S.to_long("week").alias("week"),
        *_kickoff_columns("date", "time"),
        team("home_team", mapping).alias("home_team"),
        team("away_team", mapping).alias("away_team"),
        home_s.alias("home_score"),
        away_s.alias("away_score"),
        S.to_long("attendance").alias("attendance"),
        neutral.alias("neutral_site"),
        venue.alias("venue"),
        S.strip_ws("referee").alias("referee"),
        S.strip_ws("game_id").alias("game_id"),
    )


def transform_flat(df: DataFrame, mapping=None) -> DataFrame:
    """Common finishing of flattened statistics tables (only existing columns)."""
    out = []
    for c in df.columns:
        if c == "season":
            out.append(S.to_long(c).alias(c))
        elif c in ("team", "nation"):
            out.append(team(c, mapping).alias(c))
        elif c in ("player", "league", "pos"):
            out.append(S.strip_ws(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
