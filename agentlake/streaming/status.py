"""Task status as a resumable stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.operators.joins import key_of, skew_join
from agentlake.operators.positions import with_positions
from agentlake.streaming.folded import run_folded

RUNNING, PAUSED, COMPLETED, READY = "RUNNING", "PAUSED", "COMPLETED", "READY"

#: Events of a task that are scanned together.
BLOCK_ROWS = 100_000


def next_state(state: str, kind: str, has_context: bool) -> tuple[str, bool]:
    """(state after the event, whether the event is passed on).

    A user message (re)starts the task. A paused or completed task ignores
    everything else. Input required pauses only when a context id is known.
    """
    if kind == "message":
        return RUNNING, True
    if state in (PAUSED, COMPLETED):
        return state, False
    if kind == "input_required" and has_context:
        return PAUSED, True
    if kind == "completed":
        return COMPLETED, True
    return RUNNING, True


def _stop() -> Column:
    """The state in which an event stops a running task, NULL if it does not."""
    asks = (F.col("kind") == "input_required") & F.coalesce(F.col("context_id") != "", F.lit(False))
    return F.when(F.col("kind") == "completed", F.lit(COMPLETED)).when(asks, F.lit(PAUSED))


def fold_status(events: DataFrame, states: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``next_state`` over every task's events in order: ``task_id, seq, state, emitted``.

    ``events`` hold ``task_id, seq, kind, context_id``, ``states`` the ``state``
    each ``task_id`` was left in. A block of a task's events is a small table
    of transitions: where a running task ends up, and whether a message in it
    makes the state before irrelevant. Such tables compose, so blocks are
    scanned apart, one row of each is scanned per task, and only what stands
    before a block's first message takes the state from there.
    """
    message = F.coalesce(F.col("kind") == "message", F.lit(False))
    placed = with_positions(events.select("task_id", "seq", "kind", "context_id"), ["task_id"], ["seq"], "_place")
    keyed = placed.select(
        "task_id", "seq", "_place", _stop().alias("_stop"), message.cast("int").alias("_message"),
        key_of(["task_id"]).alias("_key"), F.floor((F.col("_place") - 1) / block_rows).alias("_block"),
    )
    inside = Window.partitionBy("_key", "_block").orderBy("_place")
    stretch = Window.partitionBy("_key", "_block", "_stretch").orderBy("_place")
    scanned = (
        keyed.withColumn("_stretch", F.sum("_message").over(inside))
        .withColumn("_stopped", F.first("_stop", ignorenulls=True).over(stretch))
        .withColumn("_before", F.first("_stop", ignorenulls=True).over(stretch.rowsBetween(Window.unboundedPreceding, -1)))
    )
    blocks = scanned.groupBy("_key", "_block").agg(
        F.max("_message").alias("_restarts"), F.max_by(F.struct("_stopped"), "_place")["_stopped"].alias("_ends")
    )
    # The state so far comes first, as a block of its own.
    left = states.select(
        key_of(["task_id"]).alias("_key"),
        F.lit(-1).cast("long").alias("_block"),
        F.lit(0).alias("_restarts"),
        F.when(F.col("state").isin(PAUSED, COMPLETED), F.col("state")).alias("_ends"),
    )
    chain = Window.partitionBy("_key").orderBy("_block")
    since = Window.partitionBy("_key", "_run").orderBy("_block")
    carried = (
        blocks.unionByName(left)
        .withColumn("_run", F.sum("_restarts").over(chain))
        .withColumn("_after", F.first("_ends", ignorenulls=True).over(since))
        .withColumn("_from", F.lag("_after").over(chain))
        .filter("_block >= 0")
        .select("_key", "_block", "_from")
    )
    early = (F.col("_stretch") == 0) & F.col("_from").isNotNull()
    return skew_join(scanned, carried, ["_key", "_block"]).select(
        "task_id",
        "seq",
        F.when(early, F.col("_from")).otherwise(F.coalesce("_stopped", F.lit(RUNNING))).alias("state"),
        (~early & F.col("_before").isNull()).alias("emitted"),
    )


def stream_task_status(events: DataFrame, path: str | None = None) -> DataFrame:
    """State of every task after each event: ``task_id, seq, state, emitted``.

    ``events`` is a stream of ``task_id, seq, kind, context_id`` with kinds
    message, working, input_required and completed; ids and numbers are of any
    type that has an order. All that is available is processed. ``path`` keeps
    rows and states, so that a later run goes on from them.
    """
    kinds = events.schema
    rows = T.StructType(
        [kinds["task_id"], kinds["seq"], T.StructField("state", T.StringType()), T.StructField("emitted", T.BooleanType())]
    )
    states = T.StructType([kinds["task_id"], T.StructField("state", T.StringType())])

    def settle(done: DataFrame, _: DataFrame) -> DataFrame:
        last = done.groupBy(key_of(["task_id"]).alias("_key")).agg(F.max_by("state", "seq").alias("state"))
        return last.select("_key.task_id", "state")

    return run_folded(events, "task-status", "task_id", fold_status, settle, rows, states, path)
