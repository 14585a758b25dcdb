"""Guarded ad-hoc SQL over registered tables.

Statements run as Spark SQL: ``5/2`` is 2.5, ``LIKE`` is case-sensitive and
``"x"`` is a string literal.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.operators.paging import PAGE_ROWS
from agentlake.session import written
from agentlake.sources.sinks import to_envelope

UNRESOLVED = "UNRESOLVED_COLUMN"


def check_select(sql: str | None) -> str:
    """The statement, or ``ValueError`` unless it starts with SELECT."""
    if not sql or not sql.strip().upper().startswith("SELECT"):
        raise ValueError(f"Incorrect query {sql}")
    return sql


def run_select(spark: SparkSession, sql: str | None) -> DataFrame:
    """Run one SELECT; a failed analysis raises Spark's own exception."""
    return spark.sql(check_select(sql))


def select_or_error(spark: SparkSession, sql: str | None) -> tuple[DataFrame | None, dict | None]:
    """``(rows, None)``, or ``(None, {"error": ...})`` when analysis fails."""
    statement = check_select(sql)
    try:
        return spark.sql(statement), None
    except (AnalysisException, ParseException) as error:
        return None, {"error": _explained(error)}


def select_envelope(spark: SparkSession, sql: str | None, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The answer to one SELECT as JSON documents: ``page, envelope``.

    Pages of ``{"results": [...]}`` in the statement's order, each complete;
    without rows one empty list. A statement that is no SELECT or whose analysis
    fails gives ``{"error": ...}`` instead. NULL values have no key; of columns
    with one name the last is shown.
    """
    try:
        rows, error = select_or_error(spark, sql)
    except ValueError as refused:
        rows, error = None, {"error": str(refused)}
    if rows is None:
        return spark.createDataFrame([(0, json.dumps(error, ensure_ascii=False))], "page int, envelope string")
    last = {name: i for i, name in enumerate(rows.columns)}
    unique = rows.toDF(*[f"_{i}" for i in range(len(rows.columns))])
    named = unique.select(*[F.col(f"_{i}").alias(name) for name, i in last.items()])
    numbered = named.withColumn("_row_at", F.monotonically_increasing_id())
    pages, _, found = written(to_envelope(numbered, [], "_row_at", [f"`{name}`" for name in last], page_rows=page_rows), "select-envelope")
    if not found:
        return spark.createDataFrame([(0, json.dumps({"results": []}))], pages.schema)
    return pages


def _explained(error: AnalysisException) -> str:
    condition = error.getCondition() or ""
    if condition.startswith(UNRESOLVED):
        return f"Please check your query, {error}. Use the table schema to regenerate the query"
    return str(error)
