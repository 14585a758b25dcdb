"""Items of a task up to its terminal one, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.operators.joins import key_of, skew_join
from agentlake.operators.workflow import truncate_at_terminal
from agentlake.streaming.folded import run_folded


def stream_truncate(items: DataFrame, path: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Pass items until a task's first terminal one, then drop the rest.

    ``items`` is a stream of ``task_id, seq, content, is_task_complete,
    require_user_input``; ids and numbers are of any type that has an order. All
    that is available is processed. A task's end in a batch is a minimum, and a
    closed task one row, so a hot task is never held. ``path`` keeps rows and
    closed tasks, so that a later run goes on from them. ``ttl_ms`` forgets a
    closed task after that time; items that arrive later open it again.
    """
    kinds = items.schema
    rows = T.StructType([kinds["task_id"], kinds["seq"], kinds["content"], T.StructField("outcome", T.StringType())])
    states = T.StructType([kinds["task_id"], T.StructField("closed_at", T.TimestampType())])

    def fold(batch: DataFrame, closed: DataFrame) -> DataFrame:
        if ttl_ms is not None:
            closed = closed.filter(F.unix_millis(F.current_timestamp()) - F.unix_millis("closed_at") < ttl_ms)
        lean = batch.select("task_id", "seq", "content", "is_task_complete", "require_user_input")
        return truncate_at_terminal(skew_join(lean, closed.select("task_id"), ["task_id"], "left_anti"))

    def settle(passed: DataFrame, _: DataFrame) -> DataFrame:
        ended = passed.filter("outcome <> 'working'").groupBy(key_of(["task_id"]).alias("_key")).agg(F.current_timestamp().alias("closed_at"))
        return ended.select("_key.task_id", "closed_at")

    return run_folded(items, "task-items", "task_id", fold, settle, rows, states, path)
