from __future__ import annotations

import sys

import pandas as pd
import pytest
from pyspark import cloudpickle

from agentlake.operators import embedindex
from agentlake.operators.vectors import embed, top_match

SCHEMA = "id long, text string"
# The functions below run in workers, which cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lengths(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [float(len(t)), 1.0])


def only_new(texts: pd.Series) -> pd.Series:
    if texts.str.contains("old").any():
        raise ValueError("a kept text was embedded again")
    return lengths(texts)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "kept")


def test_only_changed_rows_are_embedded(spark, path):
    first = [(i, f"old {i}") for i in range(200)]
    embedindex.refresh(spark.createDataFrame(first, SCHEMA), path, 0, "text", fn=lengths)
    second = [(i, t if i >= 2 else f"new {i}") for i, t in first][:-1]
    table = spark.createDataFrame(second, SCHEMA)
    embedindex.refresh(table, path, 1, "text", fn=only_new)
    # Run again, as after a lost driver: nothing changes.
    embedindex.refresh(table, path, 1, "text", fn=only_new)
    assert spark.read.parquet(f"{path}/vectors/segment=1").count() == 2
    assert spark.read.parquet(f"{path}/gone/segment=1").count() == 3
    assert embedindex.stored_vectors(spark, path).count() == 199
    got = {r.id: list(r.embedding) for r in embedindex.with_stored(table, path, "text").collect()}
    assert got == {i: [float(len(t)), 1.0] for i, t in second}
    # A text that left and comes back is embedded again.
    embedindex.refresh(spark.createDataFrame(first, SCHEMA), path, 2, "text", fn=lengths)
    assert embedindex.stored_vectors(spark, path).count() == 200
    assert spark.read.parquet(f"{path}/vectors/segment=2").count() == 3


def test_repeated_null_and_missing_texts(spark, path):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "a"), (None, "a")], SCHEMA)
    embedindex.refresh(odd.withColumnRenamed("id", "hash").selectExpr("*", "1 as segment"), path, 0, "text", fn=lengths)
    assert embedindex.stored_vectors(spark, path).count() == 2
    asked = odd.union(spark.createDataFrame([(5, "unseen")], SCHEMA)).selectExpr("*", "'h' as hash", "0 as embedding")
    got = embedindex.with_stored(asked, path, "text")
    assert got.columns == ["id", "text", "hash", "embedding"]
    told = sorted((r.id or 0, r.hash, r.embedding) for r in got.collect())
    assert told == [
        (0, "h", [1.0, 1.0]), (1, "h", [0.0, 1.0]), (2, "h", [0.0, 1.0]), (3, "h", [1.0, 1.0]), (4, "h", [1.0, 1.0]),
        (5, "h", None),
    ]
    embedindex.refresh(odd.limit(0), path, 1, "text", fn=lengths)
    assert embedindex.stored_vectors(spark, path).count() == 0


def test_search_with_a_function_for_queries(spark, path, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "bbbb")], SCHEMA)
    embedindex.refresh(docs, path, 0, "text", fn=lengths)
    embedindex.compact(spark, path, str(tmp_path / "compact"))
    items = embedindex.with_stored(docs, str(tmp_path / "compact"), "text")
    asked = embed(spark.createDataFrame([(7, "short")], SCHEMA), "text", fn=lambda t: t.map(lambda _: [-1.0, 0.0]))
    found = top_match(asked.withColumnRenamed("id", "query_id"), items, "query_id", "id").collect()
    assert [(r.query_id, r.item, r.score) for r in found] == [(7, 1, -1.0)]
