import pytest

from upcharts.plans.adhoc import run_query, select_rows


@pytest.fixture(scope="module", autouse=True)
def numbers(spark):
    spark.range(60).createOrReplaceTempView("numbers")


@pytest.mark.parametrize(
    "sql,status",
    [
        ("SELECT id FROM numbers", "rows"),
        ("  select 1;  ", "rows"),
        ("WITH n AS (SELECT * FROM numbers) SELECT count(*) FROM n", "rows"),
        ("SELECT 1 -- a comment", "rows"),
        ("SELECT id FROM numbers WHERE id < 0", "empty"),
        ("DROP VIEW numbers", "rejected"),
        ("SHOW TABLES", "rejected"),
        ("WITH n AS (SELECT 1) INSERT INTO numbers SELECT * FROM n", "rejected"),
        ("INSERT INTO numbers VALUES (1)", "rejected"),
        ("SELECT 1; DROP VIEW numbers", "rejected"),
        ("SELECT missing FROM numbers", "failed"),
        ("SELECT 1 / (id - id) FROM numbers", "failed"),
    ],
)
def test_outcomes(spark, sql, status):
    assert run_query(spark, sql).status == status


def test_preview_says_that_there_is_more(spark):
    answer = run_query(spark, "SELECT id FROM numbers")
    assert len(answer.rows) == 50 and answer.more
    assert not run_query(spark, "SELECT id FROM numbers", preview=60).more
    assert select_rows(spark, "SELECT id FROM numbers").count() == 60


NOT_READ_ONLY = [
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT java_method('java.util.UUID', 'randomUUID')",
    "SELECT try_reflect('java.lang.System', 'nanoTime')",
    "SELECT max(n) FROM (SELECT length(reflect('java.lang.System', 'getenv', 'HOME')) AS n)",
    "WITH x AS (SELECT REFLECT('java.lang.System', 'gc') AS r) SELECT * FROM x",
    "SELECT 1 WHERE EXISTS (SELECT 1 WHERE java_method('java.lang.System', 'lineSeparator') IS NOT NULL)",
    "SELECT * FROM parquet.`/tmp/somewhere`",
    "SELECT * FROM text.`/etc/hostname`",
    "WITH x AS (SELECT * FROM csv.`/etc/passwd`) SELECT count(*) FROM x",
    "SELECT (SELECT max(value) FROM text.`/etc/hostname`) AS v",
    "SELECT 1 IN (SELECT id FROM json.`/tmp/a.json`)",
    "SELECT TRANSFORM (id) USING 'cat' AS (x) FROM range(3)",
]


@pytest.mark.parametrize("sql", NOT_READ_ONLY)
def test_queries_that_do_more_than_read_are_rejected(spark, sql):
    assert run_query(spark, sql).status == "rejected"
    with pytest.raises(Exception):  # noqa: B017
        select_rows(spark, sql)


def test_tables_views_and_functions_of_the_catalog_are_read(spark):
    spark.range(3).createOrReplaceTempView("three")
    for sql in (
        "WITH t AS (SELECT id FROM three) SELECT count(*) AS n FROM t WHERE id IN (SELECT id FROM three)",
        "SELECT upper('a') AS n FROM range(2) LATERAL VIEW explode(array(1)) AS x",
        "SELECT * FROM VALUES (1), (2) AS t(n)",
    ):
        assert run_query(spark, sql).status == "rows"
    assert run_query(spark, "SELECT * FROM spark_catalog.default.nowhere").status == "failed"
