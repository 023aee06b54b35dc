"""Aggregate marts over the gold facts.

Each mart is one aggregation (partial + final, one shuffle on its key) plus
lookups of labels on the small aggregated result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as S
from ..operators import lookup_join, role_union, sequential_rank


def scorer_ranking(goals: DataFrame, players: DataFrame, player_key: str = "id_joueur",
                   goal_id: str = "id_but", own_goal: str = "est_csc", penalty: str = "est_penalty",
                   label_cols=("nom", "nationalite")) -> DataFrame:
    """Goals per scorer (own goals excluded), penalties, sequential rank."""
    counted = (goals.where(~F.col(own_goal) & F.col(player_key).isNotNull())
                    .groupBy(player_key)
                    .agg(F.count(goal_id).alias("nb_buts"),
                         S.sum_or_zero(F.col(penalty).cast("int")).cast("bigint").alias("nb_penaltys")))
    named = lookup_join(counted, players.select(player_key, *label_cols), player_key, "left")
    ranked = sequential_rank(named, "nb_buts", [player_key], "rang")
    return ranked.select(F.col("rang").cast("bigint"), player_key, *label_cols,
                         "nb_buts", "nb_penaltys")


def team_record(matches: DataFrame, teams: DataFrame, home_key: str = "id_equipe_domicile",
                away_key: str = "id_equipe_exterieur", home_score: str = "score_domicile",
                away_score: str = "score_exterieur", team_key: str = "id_equipe",
                label_cols=("pays", "confederation")) -> DataFrame:
    """Wins, draws, losses, goals for and against per team over both roles."""
    views = role_union(matches, [
        {team_key: home_key, "bp": home_score, "bc": away_score},
        {team_key: away_key, "bp": away_score, "bc": home_score},
    ]).where(F.col(team_key).isNotNull())
    agg = views.groupBy(team_key).agg(
        F.count("bp").alias("nb_matchs"),
        F.sum(S.indicator(F.col("bp") > F.col("bc"))).cast("bigint").alias("victoires"),
        F.sum(S.indicator(F.col("bp") == F.col("bc"))).cast("bigint").alias("nuls"),
        F.sum(S.indicator(F.col("bp") < F.col("bc"))).cast("bigint").alias("defaites"),
        S.sum_or_zero("bp").cast("bigint").alias("buts_marques"),
        S.sum_or_zero("bc").cast("bigint").alias("buts_encaisses"),
    ).withColumn("difference_buts", F.col("buts_marques") - F.col("buts_encaisses"))
    named = lookup_join(agg, teams.select(team_key, *label_cols), team_key, "left")
    return named.select(team_key, *label_cols, "nb_matchs", "victoires", "nuls", "defaites",
                        "buts_marques", "buts_encaisses", "difference_buts")


def edition_stats(matches: DataFrame, editions: DataFrame, edition_key: str = "id_edition",
                  match_id: str = "id_match", home_score: str = "score_domicile",
                  away_score: str = "score_exterieur", attendance: str = "affluence",
                  label_cols=("annee", "pays_hote")) -> DataFrame:
    """Matches, goals (from scores), goals per match and mean attendance."""
    agg = (matches.where(F.col(edition_key).isNotNull())
                  .groupBy(edition_key)
                  .agg(F.count(match_id).alias("nb_matchs"),
                       S.sum_or_zero(home_score).alias("__bd"),
                       S.sum_or_zero(away_score).alias("__be"),
                       F.avg(attendance).alias("__att")))
    agg = agg.select(
        edition_key, "nb_matchs",
        (F.col("__bd") + F.col("__be")).cast("bigint").alias("nb_buts"),
        F.col("__att").alias("__att"),
    ).select(
        edition_key, "nb_matchs", "nb_buts",
        S.round_half_even(F.col("nb_buts") / F.col("nb_matchs"), 2).alias("moyenne_buts_par_match"),
        S.round_half_even("__att", 0).cast("bigint").alias("affluence_moyenne"),
    )
    named = lookup_join(agg, editions.select(edition_key, *label_cols), edition_key, "left")
    return named.select(edition_key, *label_cols, "nb_matchs", "nb_buts",
                        "moyenne_buts_par_match", "affluence_moyenne")


def share_by_category(df: DataFrame, category: str, count_col: str, out_count: str = "nb_buts",
                      out_share: str = "pourcentage", digits: int = 1) -> DataFrame:
    """Count per non-null category and its percentage of all counted rows.

    The total is a scalar subquery over the small aggregated result (no cross
    join, no single-partition window over the data).
    """
    per = (df.where(F.col(category).isNotNull())
             .groupBy(category).agg(F.count(count_col).alias(out_count)))
    total = per.select(F.coalesce(F.nullif(F.sum(out_count), F.lit(0)), F.lit(1))).scalar()
    return per.select(category, out_count,
                      S.round_half_even(F.lit(100.0) * F.col(out_count) / total, digits).alias(out_share))


def goals_by_period(goals: DataFrame) -> DataFrame:
    return share_by_category(goals, "periode", "id_but")


def build_marts(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "mart_classement_buteurs": scorer_ranking(t["fait_but"], t["dim_joueur"]),
        "mart_stats_equipe": team_record(t["fait_match"], t["dim_equipe"]),
        "mart_stats_edition": edition_stats(t["fait_match"], t["dim_edition"]),
        "mart_buts_par_periode": goals_by_period(t["fait_but"]),
    }
