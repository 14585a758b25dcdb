"""Registered queries against their statements, where SQL can express them."""

from __future__ import annotations

import oracle
import pytest

from agentlake.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_matches_check(spark, name):
    con = oracle.connect(FOLDER)
    assert oracle.compare(queries.QUERIES[name](spark, FOLDER), con, queries.CHECKS[name]) is None


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
