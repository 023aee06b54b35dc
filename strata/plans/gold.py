"""Gold star schema: conformed dimensions and facts with dense surrogate keys.

Dimensions are keyed 1..n in a declared sort order (:func:`dense_surrogate`);
facts look dimensions up with checked-broadcast joins; declared types follow
the served schema (INTEGER → int, BIGINT → bigint), but the goal fact's key is
a bigint: facts outgrow 2^31 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as S
from ..operators import (append_missing, constraint_report, dense_surrogate, keep_first,
                         latest_non_null, lookup_join, role_playing_join, stack_columns)
from .silver import goal_order


def build_dim_edition(editions: DataFrame) -> DataFrame:
    dim = editions.select(
        F.col("year").cast("int").alias("annee"),
        F.col("host").alias("pays_hote"),
        F.col("teams").cast("int").alias("nb_equipes"),
        F.col("champion"),
        F.col("runner_up").alias("finaliste"),
        F.col("top_scorer").alias("meilleur_buteur"),
        F.col("top_scorer_goals").cast("int").alias("meilleur_buteur_buts"),
        F.col("attendance_total").cast("bigint").alias("affluence_totale"),
        F.col("attendance_avg").cast("int").alias("affluence_moyenne"),
        F.col("matches").cast("int").alias("nb_matchs"),
    )
    return dense_surrogate(dim, ["annee", "pays_hote", "champion"], "id_edition", id_type="int")


def team_labels(sources: list[tuple[DataFrame, list[str]]], name: str = "pays") -> DataFrame:
    """Distinct non-null, non-blank labels gathered from many columns."""
    labels = stack_columns(sources, name)
    return labels.where(F.col(name).isNotNull() & (S.strip_ws(name) != "")).distinct()


def build_dim_equipe(matches: DataFrame, goals: DataFrame, editions: DataFrame,
                     ranking: DataFrame) -> DataFrame:
    names = team_labels([
        (matches, ["home_team", "away_team", "host"]),
        (goals, ["team", "opponent"]),
        (editions, ["host", "champion", "runner_up"]),
        (ranking, ["team"]),
    ])
    latest = latest_non_null(ranking.where(F.col("team").isNotNull()), ["team"],
                             ["confederation", "team_code"], ["snapshot_date", "rank"])
    dim = lookup_join(names, latest.withColumnRenamed("team", "pays"), "pays", "left", check="adaptive")
    dim = dim.select("pays", "confederation", F.col("team_code").alias("code_pays"))
    return dense_surrogate(dim, ["pays"], "id_equipe", id_type="int")


def build_dim_stade(matches: DataFrame) -> DataFrame:
    st = (matches.where(F.col("venue_name").isNotNull())
                 .select("venue_name", S.null_to_empty("venue_city").alias("venue_city"),
                         "host", "match_date", "match_key"))
    first = keep_first(st, ["venue_name", "venue_city"], ["match_date", "match_key", "host"])
    dim = first.select(F.col("venue_name").alias("nom_stade"), F.col("venue_city").alias("ville"),
                       F.col("host").alias("pays_hote"))
    return dense_surrogate(dim, ["nom_stade", "ville"], "id_stade", id_type="int")


def build_dim_joueur(player_stats: DataFrame | None, goals: DataFrame) -> DataFrame:
    scorers = (goals.select(F.col("scorer").alias("nom"))
                    .where(F.col("nom").isNotNull() & (S.strip_ws("nom") != "")))
    if player_stats is not None:
        ps = (player_stats.select(F.col("player").alias("nom"), F.col("pos").alias("poste"),
                                  F.col("nation").alias("nationalite"),
                                  F.col("season"), F.col("team"))
                          .where(F.col("nom").isNotNull()))
        known = keep_first(ps, ["nom"], ["season", "team", "poste", "nationalite"]) \
            .select("nom", "poste", "nationalite")
    else:
        known = scorers.limit(0).select(
            "nom", F.lit(None).cast("string").alias("poste"),
            F.lit(None).cast("string").alias("nationalite"))
    dim = append_missing(known, scorers, "nom")
    return dense_surrogate(dim, ["nom"], "id_joueur", id_type="int")


def build_fait_match(matches: DataFrame, dim_edition: DataFrame, dim_equipe: DataFrame,
                     dim_stade: DataFrame) -> DataFrame:
    m = matches.withColumn("venue_city", S.null_to_empty("venue_city"))
    ed = dim_edition.select("id_edition", F.col("annee").alias("__annee"))
    f = lookup_join(m, ed, m["year"] == ed["__annee"], "left")
    f = role_playing_join(f, dim_equipe, "id_equipe", "pays",
                          {"home_team": "id_equipe_domicile", "away_team": "id_equipe_exterieur"})
    st = dim_stade.select("id_stade", F.col("nom_stade").alias("__ns"), F.col("ville").alias("__v"))
    f = lookup_join(f, st, (f["venue_name"] == st["__ns"]) & (f["venue_city"] == st["__v"]), "left")
    return f.select(
        F.col("match_key").alias("id_match"),
        F.col("id_edition").cast("int"),
        F.col("id_equipe_domicile").cast("int"),
        F.col("id_equipe_exterieur").cast("int"),
        F.col("id_stade").cast("int"),
        F.col("match_date").alias("date_match"),
        F.col("year").cast("int").alias("annee"),
        F.col("round").alias("phase"),
        F.col("home_score").cast("int").alias("score_domicile"),
        F.col("away_score").cast("int").alias("score_exterieur"),
        F.col("home_xg").alias("xg_domicile"),
        F.col("away_xg").alias("xg_exterieur"),
        F.col("penalty_home").cast("int").alias("penalty_domicile"),
        F.col("penalty_away").cast("int").alias("penalty_exterieur"),
        F.coalesce(F.col("went_to_penalties"), F.lit(False)).alias("seance_tirs_au_but"),
        F.col("attendance").cast("bigint").alias("affluence"),
    )


def build_fait_but(goals: DataFrame, dim_joueur: DataFrame, dim_equipe: DataFrame) -> DataFrame:
    """Goal fact; ``goals`` must carry ``source_ordinal`` and ``position``."""
    dj = dim_joueur.select("id_joueur", F.col("nom").alias("__nom"))
    f = lookup_join(goals, dj, goals["scorer"] == dj["__nom"], "left")
    dq = dim_equipe.select("id_equipe", F.col("pays").alias("__pays"))
    f = lookup_join(f, dq, f["team"] == dq["__pays"], "left")
    f = f.select(
        F.col("match_key").alias("id_match"),
        F.col("id_joueur").cast("int"),
        F.col("id_equipe").cast("int"),
        F.col("minute").cast("int"),
        F.col("stoppage_time").cast("int").alias("temps_additionnel"),
        F.col("minute_absolute").cast("int").alias("minute_absolue"),
        F.col("period").alias("periode"),
        F.col("goal_type").alias("type_but"),
        F.coalesce(F.col("is_penalty"), F.lit(False)).alias("est_penalty"),
        F.coalesce(F.col("is_own_goal"), F.lit(False)).alias("est_csc"),
        "source_ordinal", "position",
    )
    return dense_surrogate(f, goal_order("id_match", "minute_absolue"), "id_but") \
        .drop("source_ordinal", "position")


def gold_constraints(t: dict[str, DataFrame]) -> DataFrame:
    """Primary keys of the six model tables and the seven foreign keys."""
    pks = {
        "dim_edition.id_edition": (t["dim_edition"], ["id_edition"]),
        "dim_equipe.id_equipe": (t["dim_equipe"], ["id_equipe"]),
        "dim_joueur.id_joueur": (t["dim_joueur"], ["id_joueur"]),
        "dim_stade.id_stade": (t["dim_stade"], ["id_stade"]),
        "fait_match.id_match": (t["fait_match"], ["id_match"]),
        "fait_but.id_but": (t["fait_but"], ["id_but"]),
    }
    fm, fb = t["fait_match"], t["fait_but"]
    fks = {
        "fait_match.id_edition": (fm, "id_edition", t["dim_edition"], "id_edition"),
        "fait_match.id_equipe_domicile": (fm, "id_equipe_domicile", t["dim_equipe"], "id_equipe"),
        "fait_match.id_equipe_exterieur": (fm, "id_equipe_exterieur", t["dim_equipe"], "id_equipe"),
        "fait_match.id_stade": (fm, "id_stade", t["dim_stade"], "id_stade"),
        "fait_but.id_match": (fb, "id_match", fm, "id_match"),
        "fait_but.id_joueur": (fb, "id_joueur", t["dim_joueur"], "id_joueur"),
        "fait_but.id_equipe": (fb, "id_equipe", t["dim_equipe"], "id_equipe"),
    }
    return constraint_report(pks, fks)


def unranked_teams(dim_equipe: DataFrame) -> DataFrame:
    """Team labels that found no ranking entry (no confederation, no code).

    Such labels usually need an entry in the canonical-label mapping (for
    example a joint host or an abbreviated name).
    """
    return (dim_equipe.where(F.col("confederation").isNull() & F.col("code_pays").isNull())
                      .select("id_equipe", "pays"))
