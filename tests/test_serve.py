"""Read-only served SQL: accepted and refused statements."""

import pytest

from strata.plans.serve import SQLRefused, ServedCatalog, is_read_only

# One statement or more for each construct a reader may use, over the fixture's tables.
ACCEPTED = [
    "SELECT upper(pays) AS p FROM dim_equipe WHERE id_equipe BETWEEN 1 AND 9",
    "select count(1) from Dim_Equipe -- a remark",
    "SELECT id_equipe_domicile, max(score_domicile) FROM fait_match GROUP BY 1 HAVING max(score_domicile) > 0 ORDER BY 2 DESC",
    "SELECT DISTINCT a.pays FROM dim_equipe a LEFT JOIN fait_match f ON a.id_equipe = f.id_equipe_domicile",
    "SELECT pays FROM dim_equipe UNION SELECT nom FROM mart_classement_buteurs",
    "SELECT id_equipe FROM dim_equipe EXCEPT SELECT id_equipe_exterieur FROM fait_match",
    "SELECT id_equipe FROM dim_equipe INTERSECT ALL SELECT id_equipe_domicile FROM fait_match",
    "WITH a AS (SELECT id_equipe AS i FROM dim_equipe), b AS (SELECT i + 1 AS i FROM a) SELECT sum(i) FROM b",
    "WITH dim_edition AS (SELECT 1 AS x) SELECT x FROM dim_edition",
    "SELECT pays FROM dim_equipe WHERE id_equipe IN (SELECT id_equipe_domicile FROM fait_match WHERE score_domicile > 1)",
    "SELECT pays, (SELECT max(nb_buts) FROM mart_classement_buteurs) AS best FROM dim_equipe",
    "SELECT pays, row_number() OVER (ORDER BY pays) AS n FROM dim_equipe LIMIT 1 OFFSET 1",
    "SELECT t.v FROM fait_match LATERAL VIEW explode(array(score_domicile, score_exterieur)) t AS v",
    "SELECT * FROM dim_equipe PIVOT (count(1) FOR id_equipe IN (1, 2))",
    "SELECT 'first\nSet x = 1\nDrop y' AS txt FROM dim_equipe",
    "SELECT x FROM VALUES (1), (2) AS t(x)",
]
# One statement or more for each command class, and each way round the list of tables.
REFUSED = [
    "", " \n ", "SELEC 1", "SELECT 1; SELECT 2",
    "TRUNCATE TABLE fait_match", "ALTER TABLE dim_equipe ADD COLUMN z int", "DROP VIEW dim_equipe",
    "INSERT OVERWRITE dim_equipe SELECT 3, 'z'", "DELETE FROM dim_equipe WHERE id_equipe = 1", "UPDATE fait_match SET score_domicile = 0",
    "MERGE INTO dim_equipe t USING fait_match s ON t.id_equipe = s.id_equipe_domicile WHEN MATCHED THEN DELETE",
    "CREATE TABLE z AS SELECT pays FROM dim_equipe", "CREATE OR REPLACE TEMP VIEW dim_equipe AS SELECT 1 AS x", "CREATE DATABASE z",
    "UNCACHE TABLE dim_equipe", "REFRESH TABLE dim_equipe", "RESET", "SET spark.sql.ansi.enabled = false", "USE default",
    "SHOW TABLES", "DESCRIBE dim_equipe", "EXPLAIN SELECT pays FROM dim_equipe", "ADD JAR '/tmp/z.jar'", "ANALYZE TABLE dim_equipe COMPUTE STATISTICS",
    "SELECT * FROM hidden_t", "SELECT * FROM default.hidden_t", "SELECT * FROM spark_catalog.default.hidden_t",
    "SELECT * FROM global_temp.hidden_g", "SELECT * FROM csv.`/etc`", "SELECT * FROM dim_joueur",
    "SELECT pays FROM dim_equipe WHERE EXISTS (SELECT 1 FROM hidden_t)", "SELECT (SELECT max(secret) FROM hidden_t) AS s FROM dim_equipe",
    "WITH hidden_t AS (SELECT * FROM hidden_t) SELECT * FROM hidden_t",
    "WITH b AS (SELECT * FROM a), a AS (SELECT 1 AS x) SELECT * FROM b",
    "SELECT * FROM (WITH c AS (SELECT 1 AS x) SELECT * FROM c) JOIN c",
    "SELECT * FROM dim_equipe, LATERAL (SELECT * FROM hidden_t)", "SELECT * FROM explode(array(1, 2))",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM dim_equipe",
    "SELECT pays FROM dim_equipe ORDER BY java_method('java.lang.Math', 'abs', id_equipe)",
    "SELECT no_such_column FROM dim_equipe",
]


@pytest.fixture(scope="module")
def catalog(spark):
    def frame(rows, schema):
        return lambda s: s.createDataFrame(rows, schema)
    spark.sql("SELECT 1 AS secret").write.mode("overwrite").saveAsTable("hidden_t")
    spark.sql("SELECT 2 AS secret").createOrReplaceGlobalTempView("hidden_g")
    yield ServedCatalog(spark, {
        "dim_equipe": frame([(1, "Argentina"), (2, "France")], "id_equipe int, pays string"),
        "fait_match": frame([(1, 2, 3, 3), (2, 1, 1, 2)],
                            "id_equipe_domicile int, id_equipe_exterieur int, score_domicile int, "
                            "score_exterieur int"),
        "mart_classement_buteurs": frame([("Messi", 7)], "nom string, nb_buts bigint"),
    })
    spark.sql("DROP TABLE hidden_t")
    spark.catalog.dropGlobalTempView("hidden_g")


@pytest.mark.parametrize("sql", ACCEPTED)
def test_accepted(catalog, sql):
    ok, why = is_read_only(catalog, sql)
    assert ok, why


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(catalog, sql):
    ok, _ = is_read_only(catalog, sql)
    assert not ok
    with pytest.raises(SQLRefused):
        catalog.sql(sql)


def test_order_and_rows(catalog):
    assert [r.pays for r in catalog.run("SELECT pays FROM dim_equipe ORDER BY pays DESC")] == ["France", "Argentina"]
    assert [r[0] for r in catalog.stream("SELECT score_domicile + score_exterieur AS n FROM fait_match ORDER BY n")] == [3, 6]


def test_only_tables_of_the_schema_can_be_served(spark):
    with pytest.raises(ValueError):
        ServedCatalog(spark, {"hidden_t": lambda s: s.range(1)})


def test_catalog_holds_only_listed_views(catalog):
    names = {t.name for t in catalog.session.catalog.listTables() if t.isTemporary}
    assert names == {"dim_equipe", "fait_match", "mart_classement_buteurs"}


def test_statement_time_limit_interrupts(spark):
    import time
    cat = ServedCatalog(spark, {
        "dim_equipe": lambda s: s.createDataFrame([(1, "A")], "id_equipe int, pays string"),
        "fait_but": lambda s: s.range(0, 100000000000).withColumnRenamed("id", "id_but"),
    }, timeout_s=1.0)
    t0 = time.time()
    with pytest.raises(Exception):
        cat.run("SELECT sum(id_but) FROM fait_but")
    assert time.time() - t0 < 60
    assert cat.run("SELECT count(*) FROM dim_equipe")[0][0] == 1   # session still usable
