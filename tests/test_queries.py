"""Every registered query against its DuckDB statement on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


#: The training-data operators have tests of their own folder.
NAMES = sorted(contract.catalog.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_check(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    check = contract.oracle_sql().get(name)
    assert check is not None, "every query has a check"
    assert oracle.compare(result, duck, check) is None


def test_entry_is_the_flagship(spark):
    assert contract.entry(spark).columns == ["vec_id", "item", "score", "rank"]
