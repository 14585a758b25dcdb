"""Register of the queries and of their check statements.

A query is a function of ``Fixtures``. Its check is a DuckDB statement over
the same fixtures; a few results cannot be stated that way and have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agentlake.fixtures import Fixtures, oracle
from agentlake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(
    check: str | None = None, needs: tuple[str, ...] = (), name: str | None = None
) -> Callable[[Callable[[Fixtures], DataFrame]], Callable[[Fixtures], DataFrame]]:
    """Register a query under its function's name."""

    def register(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Fixtures(configure(spark), folder))

        QUERIES[key] = run
        if check is not None:
            CHECKS[key] = oracle(check, *needs) if needs else check
        return build

    return register


def load() -> None:
    """Import every module that registers queries."""
    from agentlake.plans import (  # noqa: F401
        queries_agents,
        queries_cluster,
        queries_text,
        queries_travel,
        queries_workflow,
    )
