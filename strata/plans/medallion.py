"""End-to-end layers: raw files → bronze → silver → gold → served SQL.

* ``run_bronze`` copies raw CSV files unchanged to ``<prefix>/ingest_date=D/``.
* ``run_silver`` resolves the newest bronze copy of every source, runs the
  silver table jobs and writes each table as the ``ingest_date=D`` partition
  of its folder, with a manifest of row counts observed during the writes.
* ``run_gold`` builds the star schema from the newest silver partitions,
  writes it to a fresh run folder, checks primary and foreign keys on the
  written tables, builds the marts, and only then moves the ``current_run``
  pointer, so readers never see a half-built or inconsistent schema.
* ``served_catalog`` opens the read-only SQL surface over the current run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import assert_constraints
from ..sources import bronze
from ..sources.csv import read_multiheader_csv, read_raw_csv
from ..sources.partitions import partition_dates, read_latest
from ..sources.records import read_csv_files
from ..sources.publish import Publication
from ..sources.sinks import audited_writes, manifest
from . import gold, marts, silver
from .serve import ServedCatalog

# Fixed values: (bronze prefix, file name) → logical source.
SOURCES = {
    ("raw_kaggle", "matches_1930_2022.csv"): "matches",
    ("raw_kaggle", "world_cup.csv"): "editions",
    ("raw_kaggle", "schedule_2026.csv"): "schedule_2026",
    ("raw_soccerdata", "schedule.csv"): "fbref_schedule",
    ("raw_soccerdata", "player_stats.csv"): "player_stats",
    ("raw_soccerdata", "player_shooting.csv"): "player_shooting",
    ("raw_soccerdata", "team_stats.csv"): "team_stats",
}
# Ranking snapshots, kept per file name.
RANKING_PREFIX = "raw_kaggle"
RANKING_FILES = r"^fifa_ranking_.*\.csv$"

class NoBronzeInput(FileNotFoundError):
    pass


def run_bronze(spark: SparkSession, raw_root: str, bronze_root: str, ingest_date: str,
               write_manifest: bool = True) -> DataFrame:
    """Land every raw CSV under ``bronze_root``; returns (key, size_bytes, source, md5).

    The manifest (run, time, object count, total bytes, object list) goes to
    ``_manifests/ingest_date=D``.
    """
    uploads = bronze.land(spark, raw_root, bronze_root, ingest_date)
    if write_manifest:
        base = f"{bronze_root.rstrip('/')}/_manifests/ingest_date={ingest_date}"
        bronze.write_manifest(uploads, base, uuid.uuid4().hex[:12], ingest_date)
    return uploads


def resolve_inputs(spark: SparkSession, bronze_root: str) -> dict:
    """Newest bronze copy of each wanted source; ranking snapshots per file.

    The listing is metadata only (``binaryFile`` with path selected); the
    newest copy per source is chosen by an aggregation, so only the chosen
    paths (one per source or ranking file) reach the driver.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                  .option("pathGlobFilter", "*.csv").load(bronze_root).select("path"))
    pat = r"/([^/]+)/ingest_date=(\d{4}-\d{2}-\d{2})/(?:.*/)?([^/]+)$"
    parsed = files.select("path", F.regexp_extract("path", pat, 1).alias("prefix"),
                          F.regexp_extract("path", pat, 2).alias("date"),
                          F.regexp_extract("path", pat, 3).alias("name")).where(F.col("date") != "")
    registry = spark.createDataFrame([(p, n, logical) for (p, n), logical in SOURCES.items()],
                                     "prefix string, name string, logical string")
    wanted = parsed.join(F.broadcast(registry), ["prefix", "name"], "inner")
    ranking = (parsed.where((F.col("prefix") == RANKING_PREFIX) & F.col("name").rlike(RANKING_FILES))
                     .select("path", "date", F.concat(F.lit("fifa_ranking:"), F.col("name")).alias("logical")))
    chosen = (wanted.select("path", "date", "logical").unionByName(ranking)
                    .groupBy("logical").agg(F.max(F.struct("date", "path")).alias("newest"))
                    .select("logical", "newest.path").collect())
    out: dict = {r.logical: r.path for r in chosen if not r.logical.startswith("fifa_ranking:")}
    out["fifa_ranking"] = sorted(r.path for r in chosen if r.logical.startswith("fifa_ranking:"))
    if not out.get("matches") and not out["fifa_ranking"]:
        raise NoBronzeInput(f"no usable bronze input under {bronze_root}")
    return out


def silver_tables(spark: SparkSession, inputs: dict, multiline: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Silver DataFrames for the sources present (absent ones are skipped).

    ``multiline`` names the sources whose cells may hold newlines.
    """
    def read(source: str) -> DataFrame:
        return read_csv_files(spark, inputs[source]).drop("source_file") if source in multiline else read_raw_csv(spark, inputs[source])

    t: dict[str, DataFrame] = {}
    if inputs.get("matches"):
        raw = read("matches")
        t["matches"] = silver.transform_matches(raw)
        t["goals"] = silver.transform_goals(raw, keep_order_columns=True)
    if inputs.get("editions"):
        t["editions"] = silver.transform_editions(read("editions"))
    if inputs.get("fifa_ranking"):
        t["fifa_ranking"] = silver.transform_fifa_ranking(read_csv_files(spark, inputs["fifa_ranking"]))
    if inputs.get("schedule_2026"):
        t["schedule_2026"] = silver.transform_schedule_2026(read("schedule_2026"))
    if inputs.get("fbref_schedule"):
        t["fbref_schedule"] = silver.transform_fbref_schedule(read("fbref_schedule"))
    for name, n_index in (("player_stats", 4), ("player_shooting", 4), ("team_stats", 3)):
        if inputs.get(name):
            t[name] = silver.transform_flat(read_multiheader_csv(spark, inputs[name], n_index))
    return t


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, ingest_date: str,
               multiline: tuple[str, ...] = ()) -> DataFrame:
    """Write every silver table for ``ingest_date`` and its manifest.

    Returns the audit (table_name, path, n_rows, size_bytes, source); the manifest JSON goes to
    ``_manifests/ingest_date=D``.
    """
    inputs = resolve_inputs(spark, bronze_root)
    sources = {name: f"{len(x)} snapshot files" if isinstance(x, list) else x for name, x in inputs.items()}
    sources["goals"] = sources.get("matches")
    audit = audited_writes(spark, silver_tables(spark, inputs, multiline), silver_root, ingest_date, sources)
    base = f"{silver_root.rstrip('/')}/_manifests/ingest_date={ingest_date}"
    manifest(audit, uuid.uuid4().hex[:12], ingest_date).coalesce(1).write.mode("overwrite").json(f"{base}/summary")
    audit.write.mode("overwrite").json(f"{base}/tables")
    return audit


def read_silver(spark: SparkSession, silver_root: str, table: str, as_of: str | None = None) -> DataFrame:
    return read_latest(spark, f"{silver_root.rstrip('/')}/{table}", as_of=as_of).drop("ingest_date")


def _has_table(spark: SparkSession, silver_root: str, table: str) -> bool:
    """Whether the table has a partition; only a missing path counts as absent, other errors are raised."""
    return bool(partition_dates(spark, f"{silver_root.rstrip('/')}/{table}"))


# Declared types of the served model (INTEGER → int, BIGINT → bigint).
GOLD_SCHEMAS = {
    "dim_edition": "id_edition int, annee int, pays_hote string, nb_equipes int, champion string, "
                   "finaliste string, meilleur_buteur string, meilleur_buteur_buts int, "
                   "affluence_totale bigint, affluence_moyenne int, nb_matchs int",
    "dim_equipe": "id_equipe int, pays string, confederation string, code_pays string",
    "dim_joueur": "id_joueur int, nom string, poste string, nationalite string",
    "dim_stade": "id_stade int, nom_stade string, ville string, pays_hote string",
    "fait_match": "id_match string, id_edition int, id_equipe_domicile int, id_equipe_exterieur int, "
                  "id_stade int, date_match date, annee int, phase string, score_domicile int, "
                  "score_exterieur int, xg_domicile double, xg_exterieur double, penalty_domicile int, "
                  "penalty_exterieur int, seance_tirs_au_but boolean, affluence bigint",
    "fait_but": "id_but bigint, id_match string, id_joueur int, id_equipe int, minute int, "
                "temps_additionnel int, minute_absolue int, periode string, type_but string, "
                "est_penalty boolean, est_csc boolean",
    "mart_classement_buteurs": "rang bigint, id_joueur int, nom string, nationalite string, "
                               "nb_buts bigint, nb_penaltys bigint",
    "mart_stats_edition": "id_edition int, annee int, pays_hote string, nb_matchs bigint, nb_buts bigint, "
                          "moyenne_buts_par_match double, affluence_moyenne bigint",
    "mart_stats_equipe": "id_equipe int, pays string, confederation string, nb_matchs bigint, "
                         "victoires bigint, nuls bigint, defaites bigint, buts_marques bigint, "
                         "buts_encaisses bigint, difference_buts bigint",
    "mart_buts_par_periode": "periode string, nb_buts bigint, pourcentage double",
}


def _schema(name: str) -> T.StructType:
    return T._parse_datatype_string(GOLD_SCHEMAS[name])


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, as_of: str | None = None,
             run_id: str | None = None) -> dict[str, str]:
    """Build, write, check and publish the gold schema; returns table → path."""
    run_id = run_id or uuid.uuid4().hex[:12]
    run, paths = Publication(spark, gold_root), {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        paths[name] = run.path(run_id, name)
        return run.write(run_id, name, df, _schema(name))

    m = read_silver(spark, silver_root, "matches", as_of)
    g = read_silver(spark, silver_root, "goals", as_of)
    ed = read_silver(spark, silver_root, "editions", as_of)
    fifa = read_silver(spark, silver_root, "fifa_ranking", as_of)
    ps = read_silver(spark, silver_root, "player_stats", as_of) \
        if _has_table(spark, silver_root, "player_stats") else None

    t: dict[str, DataFrame] = {}
    t["dim_edition"] = publish("dim_edition", gold.build_dim_edition(ed))
    t["dim_equipe"] = publish("dim_equipe", gold.build_dim_equipe(m, g, ed, fifa))
    t["dim_stade"] = publish("dim_stade", gold.build_dim_stade(m))
    t["dim_joueur"] = publish("dim_joueur", gold.build_dim_joueur(ps, g))
    t["fait_match"] = publish("fait_match", gold.build_fait_match(
        m, t["dim_edition"], t["dim_equipe"], t["dim_stade"]))
    t["fait_but"] = publish("fait_but", gold.build_fait_but(g, t["dim_joueur"], t["dim_equipe"]))
    # All-or-nothing: nothing is published when a key is violated.
    assert_constraints(gold.gold_constraints(t))
    for name, df in marts.build_marts(t).items():
        publish(name, df)
    run.commit(run_id, list(paths))
    return paths


def current_paths(spark: SparkSession, gold_root: str) -> dict[str, str]:
    run_id = spark.read.text(f"{gold_root.rstrip('/')}/current_run").first()[0]
    base = f"{gold_root.rstrip('/')}/runs/{run_id}"
    return {name: f"{base}/{name}" for name in GOLD_SCHEMAS}


def served_catalog(spark: SparkSession, gold_root: str) -> ServedCatalog:
    """Read-only SQL over the currently published gold tables."""
    return ServedCatalog(spark, current_paths(spark, gold_root))


def table_counts(spark: SparkSession, gold_root: str) -> DataFrame:
    """Row count of each published gold table (one row per table)."""
    frames = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(n).alias("table_name"), "n_rows")
              for n, p in current_paths(spark, gold_root).items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out
