"""Plans that must hold when one key owns a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from agentlake.operators import workflow


@pytest.fixture
def tight(spark):
    """Settings under which a small table already counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot_items(spark):
    """A third of the items belong to task 0."""
    ids = spark.range(0, 60_000, 1, 8)
    task = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1)
    return ids.select(
        task.cast("long").alias("task_id"), F.col("id").alias("seq"), F.md5(F.col("id").cast("string")).alias("content"),
        (F.col("id") % 997 == 996).alias("is_task_complete"), F.lit(False).alias("require_user_input"),
    )


def test_truncation_splits_a_hot_task(tight):
    df = workflow.truncate_at_terminal(hot_items(tight))
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_islands_spread_a_hot_stream(spark):
    messages = spark.range(50_000).select(
        F.lit("s").alias("stream_id"), F.col("id").alias("seq"), (F.col("id") % 100 < 50).cast("string").alias("context_id"),
        F.lit("q").alias("query"), F.lit(False).alias("completed"),
    )
    found = workflow.session_islands(messages, block_rows=1000)
    assert found.agg(F.max("island")).first()[0] == 50_000 // 50 - 1
