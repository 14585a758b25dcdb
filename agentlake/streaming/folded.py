"""Streams folded batch by batch with DataFrame operators only.

Each micro-batch is a table. It is folded together with the keys' states, which
are tables of the shared folder as well: a batch adds the states it changed, and
every so many batches all states are written anew. A hot key is whatever the
fold makes of it; no task holds the rows of a key.

Rows and states are written below the number of their batch and overwrite an
earlier attempt, so a batch that is repeated after a failure counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.operators.joins import key_of
from agentlake.session import scratch_path

#: Batches between two complete tables of states.
WHOLE_EVERY = 16

Fold = Callable[[DataFrame, DataFrame], DataFrame]
Settle = Callable[[DataFrame, DataFrame], DataFrame]


def run_batches(stream: DataFrame, path: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hand every available micro-batch and its number to ``each``; ``path`` keeps the progress."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_folded(
    stream: DataFrame, name: str, key: str, fold: Fold, settle: Settle, rows: T.StructType, states: T.StructType, path: str | None = None
) -> DataFrame:
    """Process all available input and read back all rows, those of earlier runs
    on ``path`` included.

    ``fold(batch, states)`` gives the rows of a batch; ``settle(rows, batch)``
    the states they lead to, one per key. ``path`` keeps rows, states and
    progress; a later run on it goes on where the last one ended.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    spark.createDataFrame([], rows).write.mode("overwrite").parquet(f"{path}/rows/batch=-1")

    def known(number: int) -> DataFrame:
        """The states before batch ``number``."""
        whole = (number - 1) // WHOLE_EVERY * WHOLE_EVERY
        parts = [f"{path}/states/batch={i}" for i in range(max(whole, 0), number)]
        if not parts:
            return spark.createDataFrame([], states)
        read = spark.read.schema(states).option("basePath", f"{path}/states").parquet(*parts)
        latest = read.groupBy(key_of([key]).alias("_key")).agg(F.max_by(F.struct(*states.names), "batch").alias("_last"))
        return latest.select("_last.*")

    def each(batch: DataFrame, number: int) -> None:
        target, before = f"{path}/rows/batch={number}", known(number)
        fold(batch, before).select(*rows.names).write.mode("overwrite").parquet(target)
        changed = settle(spark.read.schema(rows).parquet(target), batch).select(*states.names)
        if number % WHOLE_EVERY == 0:
            kept = before.alias("b").join(changed.alias("c"), F.col(f"b.{key}").eqNullSafe(F.col(f"c.{key}")), "left_anti")
            changed = changed.unionByName(kept)
        changed.write.mode("overwrite").parquet(f"{path}/states/batch={number}")

    run_batches(stream, path, each)
    return spark.read.schema(rows).parquet(f"{path}/rows").drop("batch")
