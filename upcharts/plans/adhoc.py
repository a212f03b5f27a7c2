"""Read-only ad-hoc SQL over the catalog."""

from collections.abc import Iterator
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

# rows fetched for display
PREVIEW_ROWS = 50


@dataclass
class Answer:
    """Outcome of a query: ``rows``, ``empty``, ``rejected`` or ``failed``.

    ``rows`` is a preview; ``more`` says that the result goes on.
    """

    status: str
    rows: list[Row] = field(default_factory=list)
    message: str = ""
    more: bool = False


class Refused(ValueError):
    """The query does more than read the catalog's tables."""


#: expressions that call into the JVM, by their class in an analysed plan
_CALLS = {"CallMethodViaReflection", "TryReflect"}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _plans(plan) -> Iterator:
    """A logical plan, all plans below it, in its WITH clauses and in its subqueries."""
    yield plan
    for below in (plan.children(), plan.innerChildren(), plan.subqueries()):
        for child in _items(below):
            yield from _plans(child)


def _expressions(plan) -> Iterator:
    waiting = _items(plan.expressions())
    while waiting:
        expression = waiting.pop()
        yield expression
        waiting += _items(expression.children())


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _check_sources(spark: SparkSession, parsed) -> None:
    """Refuse scripts, and names of two or more parts that are not of the catalog: files as tables."""
    catalogs = {c.name for c in spark.catalog.listCatalogs()} | {"spark_catalog"}
    for plan in _plans(parsed):
        if "ScriptTransformation" in _kind(plan):
            raise Refused("scripts are not allowed")
        if _kind(plan) != "UnresolvedRelation":
            continue
        *place, _ = _items(plan.multipartIdentifier())
        known = not place or place[0] in catalogs or (len(place) == 1 and spark.catalog.databaseExists(place[0]))
        if not known:
            raise Refused(f"not a table of the catalog: {plan.tableName()}")


def _check_calls(analysed) -> None:
    """Refuse functions that call Java methods, whatever name they go by."""
    for plan in _plans(analysed):
        for expression in _expressions(plan):
            if _kind(expression) in _CALLS:
                raise Refused(f"calls of Java methods are not allowed: {expression.sql()}")


def select_rows(spark: SparkSession, sql: str) -> DataFrame:
    """All rows of a query that only reads tables and views of the catalog.

    The text is placed in a subquery, whose grammar admits queries only, so
    commands and second statements do not parse. The parsed plan may name no files and
    no scripts, the analysed one may call no Java methods; otherwise ``Refused`` is raised.
    """
    query = sql.strip().removesuffix(";")
    # the closing bracket has its own line: a trailing comment cannot hide it
    text = f"SELECT * FROM (\n{query}\n)"
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Py4JJavaError:
        # the same text again, for Spark's own error
        return spark.sql(text)
    _check_sources(spark, parsed)
    result = spark.sql(text)
    _check_calls(result._jdf.queryExecution().analyzed())
    return result


def run_query(spark: SparkSession, sql: str, preview: int = PREVIEW_ROWS) -> Answer:
    """Run a query, fetch ``preview`` rows, and keep its three bad outcomes apart."""
    if not sql.strip().upper().startswith(("SELECT", "WITH")):
        return Answer("rejected", message="only SELECT queries are allowed")
    try:
        result = select_rows(spark, sql)
    except (ParseException, Refused) as error:
        return Answer("rejected", message=str(error))
    except AnalysisException as error:
        return Answer("failed", message=str(error))
    try:
        rows = result.take(preview + 1)
    except PySparkException as error:
        return Answer("failed", message=str(error))
    return Answer("rows", rows[:preview], more=len(rows) > preview) if rows else Answer("empty")
