"""Read-only SQL over the published gold tables.

A served catalog is a separate ``SparkSession`` (``newSession()``) that holds
only the allow-listed gold tables as temporary views and cannot read files by
path (``spark.sql.runSQLOnFiles=false``).  The new session still shares the
catalog and the global views, so a statement is judged before it runs, from
the plan object of Spark's own parser: see :meth:`ServedCatalog.classify`.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Tables of the served gold schema.
GOLD_TABLES = (
    "dim_edition", "dim_equipe", "dim_joueur", "dim_stade",
    "fait_match", "fait_but",
    "mart_classement_buteurs", "mart_stats_edition",
    "mart_stats_equipe", "mart_buts_par_periode",
)

# Default statement time limit of the served surface, in seconds.
STATEMENT_TIMEOUT_S = 15.0

# Node classes of a parsed statement that only read.  Anything else (commands,
# writes, table functions, identifiers given as values) is refused.
_READ_NODES = {
    "Project", "Aggregate", "Filter", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Union", "Intersect", "Except",
    "Distinct", "Join", "Window", "UnresolvedWith", "SubqueryAlias", "UnresolvedRelation", "Generate", "Pivot",
    "Unpivot", "UnresolvedHint", "LateralJoin", "Sample", "OneRowRelation", "UnresolvedInlineTable", "LocalRelation",
    "WithWindowDefinition", "UnresolvedHaving", "UnresolvedSubqueryColumnAliases",
}
# Functions that call into the JVM by name.
_REFUSED_FUNCTIONS = {"reflect", "java_method", "try_reflect"}


def _items(seq) -> list:
    """A Scala sequence as a list."""
    return [seq.apply(i) for i in range(seq.size())]


class SQLRefused(ValueError):
    pass


class ServedCatalog:
    """Allow-listed, read-only SQL surface over a set of tables.

    ``tables`` maps a view name to either a path of a published Parquet table
    or a callable ``session -> DataFrame`` that builds it inside the served
    session.
    """

    def __init__(self, spark: SparkSession,
                 tables: dict[str, str | Callable[[SparkSession], DataFrame]],
                 timeout_s: float = STATEMENT_TIMEOUT_S):
        unknown = sorted(set(tables) - set(GOLD_TABLES))
        if unknown:
            raise ValueError(f"not tables of the served schema: {', '.join(unknown)}")
        self.session = spark.newSession()
        self.session.conf.set("spark.sql.runSQLOnFiles", "false")
        self.timeout_s = timeout_s
        for name, src in tables.items():
            df = self.session.read.parquet(src) if isinstance(src, str) else src(self.session)
            df.createOrReplaceTempView(name)
        self.tables = tuple(tables)

    def classify(self, sql: str) -> str:
        """Return the parsed root node of a read-only query, else raise.

        Decides on the plan object of Spark's parser: every node must be one
        that reads, and every relation must be a served table by its plain
        name or a common table expression in scope.
        """
        if not sql or not sql.strip():
            raise SQLRefused("empty statement")
        try:
            plan = self.session._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";"))
        except Exception as e:  # parse errors, several statements
            raise SQLRefused(f"not a single parsable statement: {str(e).splitlines()[0]}") from e
        self._check(plan, frozenset())
        return plan.nodeName()

    def _check(self, node, scope: frozenset) -> None:
        name = node.getClass().getSimpleName().rstrip("$")
        if name not in _READ_NODES:
            raise SQLRefused(f"only queries over the served tables are allowed (got {name})")
        if name == "UnresolvedRelation":
            parts = _items(node.multipartIdentifier())
            if len(parts) != 1 or parts[0].lower() not in scope | set(self.tables):
                raise SQLRefused(f"not a served table: {'.'.join(parts)}")
        for expression in _items(node.expressions()):
            self._check_functions(expression)
        for subquery in _items(node.subqueries()):
            self._check(subquery, scope)
        if name == "UnresolvedWith":
            # A common table expression sees those before it, never itself.
            for relation in _items(node.cteRelations()):
                self._check(relation._2(), scope)
                scope = scope | {relation._1().lower()}
        for child in _items(node.children()):
            self._check(child, scope)

    def _check_functions(self, expression) -> None:
        if expression.getClass().getSimpleName() == "UnresolvedFunction":
            parts = [p.lower() for p in _items(expression.nameParts())]
            if parts[-1] in _REFUSED_FUNCTIONS:
                raise SQLRefused(f"function refused: {'.'.join(parts)}")
        for child in _items(expression.children()):
            self._check_functions(child)

    def sql(self, sql: str) -> DataFrame:
        """Validate then plan ``sql``; the result is a lazy DataFrame."""
        self.classify(sql)
        try:
            return self.session.sql(sql.strip().rstrip(";"))
        except Exception as e:  # unknown columns and the like
            raise SQLRefused(str(e).splitlines()[0]) from e

    def stream(self, sql: str):
        """Validate, execute with the statement time limit, give the rows one partition at a time."""
        df = self.sql(sql)
        tag = "strata-served-" + uuid.uuid4().hex[:8]
        self.session.addTag(tag)
        timer = threading.Timer(self.timeout_s, lambda: self.session.interruptTag(tag))
        timer.start()
        try:
            yield from df.toLocalIterator()
        finally:
            timer.cancel()
            self.session.removeTag(tag)

    def run(self, sql: str) -> list:
        """The rows of :meth:`stream` as a list, for results known to be small."""
        return list(self.stream(sql))


def is_read_only(catalog: ServedCatalog, sql: str) -> tuple[bool, str]:
    try:
        catalog.sql(sql)
        return True, ""
    except SQLRefused as e:
        return False, str(e)
