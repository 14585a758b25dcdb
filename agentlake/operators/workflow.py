"""Plans, task items, messages and node events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.operators.joins import key_of, skew_join
from agentlake.operators.paging import PAGE_ROWS, paged_list, paged_text
from agentlake.operators.positions import with_positions

PLANNER_NODE = "planner"
PLANNER_ARTIFACT = "PlannerAgent-result"
BLOCK_ROWS = 100_000


def plan_edges(plans: DataFrame, plan_key: str = "plan_id", tasks: str = "tasks") -> DataFrame:
    """Chain of each plan: ``plan_key, pos, src, dst, description``.

    The first task hangs off the planner node, each further one off the task
    before it. Node names are ``planner`` and the task's place from 1. Done
    inside the array of one row, so nothing is shuffled.
    """
    exploded = plans.select(plan_key, F.posexplode(tasks).alias("_at", "_task"))
    return exploded.select(
        plan_key,
        (F.col("_at") + 1).alias("pos"),
        F.when(F.col("_at") == 0, F.lit(PLANNER_NODE)).otherwise(F.col("_at").cast("string")).alias("src"),
        (F.col("_at") + 1).cast("string").alias("dst"),
        F.col("_task")["description"].alias("description"),
    )


def truncate_at_terminal(
    items: DataFrame, key: str = "task_id", seq: str = "seq", text_completes: bool = False
) -> DataFrame:
    """Items up to and including the first terminal one, with ``outcome``.

    ``outcome`` is complete, input_required or working; complete is tested
    first. ``text_completes`` treats every item without a flag (plain text) as
    complete. The end of a task is a minimum, summed before the shuffle, so a
    hot task is cut without being sorted.
    """
    done = F.coalesce(F.col("is_task_complete"), F.lit(text_completes))
    asks = F.coalesce(F.col("require_user_input"), F.lit(False))
    outcome = F.when(done, F.lit("complete")).when(asks, F.lit("input_required")).otherwise(F.lit("working"))
    judged = items.withColumn("outcome", outcome)
    ends = judged.filter(F.col("outcome") != "working").groupBy(key).agg(F.min(seq).alias("_end"))
    return (
        skew_join(judged, ends, [key], "left")
        .filter(F.col("_end").isNull() | (F.col(seq) <= F.col("_end")))
        .drop("_end")
    )


def session_islands(
    messages: DataFrame,
    stream: str = "stream_id",
    seq: str = "seq",
    context: str = "context_id",
    completed: str = "completed",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``island``: the number of state clears before and at each message.

    State is cleared when the context differs from the previous message's, and
    after a completed workflow. The scan runs in two levels: inside blocks of
    ``block_rows`` messages of a stream, then over one summary row per block, so a
    hot stream is spread over as many tasks as it has blocks.
    """
    inside = Window.partitionBy("_key", "_block").orderBy(seq)
    before = Window.partitionBy("_key").orderBy("_block")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    state = F.struct(F.col(context).alias("context"), F.coalesce(completed, F.lit(False)).alias("done"))
    previous = F.lag("_state").over(inside)
    steps = (
        with_positions(messages, [stream], [seq], "_place")
        .withColumns({"_key": key_of([stream]), "_block": F.floor((F.col("_place") - 1) / block_rows), "_state": state})
        .withColumn("_break", _clears(previous, F.col("_state")))
        .withColumn("_within", F.sum("_break").over(inside))
    )
    blocks = (
        steps.groupBy("_key", "_block")
        .agg(
            F.min_by("_state", seq).alias("_first"),
            F.max_by("_state", seq).alias("_last"),
            F.max("_within").alias("_breaks"),
        )
        .withColumn("_start", _clears(F.lag("_last").over(before), F.col("_first")))
        .select(
            "_key",
            "_block",
            (
                F.sum("_start").over(before) + F.coalesce(F.sum("_breaks").over(earlier), F.lit(0))
            ).alias("_offset"),
        )
    )
    return steps.join(blocks, ["_key", "_block"]).select(
        *messages.columns, (F.col("_offset") + F.col("_within")).cast("long").alias("island")
    )


def _clears(previous: Column, current: Column) -> Column:
    """1 when the state before ``current`` is cleared, 0 for the first message."""
    changed = ~previous["context"].eqNullSafe(current["context"]) | previous["done"]
    return F.when(previous.isNull(), F.lit(0)).otherwise(changed.cast("int"))


def session_history(
    islands: DataFrame,
    stream: str = "stream_id",
    seq: str = "seq",
    query: str = "query",
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Queries since the last clear, in order: ``stream, island, page, history``."""
    return paged_list(islands, [stream, "island"], seq, F.col(query), "history", page_rows)


def merge_attributes(
    updates: DataFrame, key: str = "node_id", seq: str = "seq", attributes: Sequence[str] = ()
) -> DataFrame:
    """Each node's attributes: the last value that is neither NULL nor empty."""
    merged = [
        F.max_by(F.col(a), F.when(F.coalesce(F.col(a) != "", F.lit(False)), F.col(seq))).alias(a)
        for a in attributes
    ]
    return updates.groupBy(key).agg(*merged)


def latest_status(
    events: DataFrame, key: str = "node_id", order: Sequence[str] = ("ts", "seq"), columns: Sequence[str] = ("state",)
) -> DataFrame:
    """State of each node after its last transition."""
    last = F.max_by(F.struct(*columns, *order), F.struct(*order))
    return events.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def collect_artifacts(
    events: DataFrame, context: str = "context_id", seq: str = "seq", page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Artifacts in arrival order: ``context, page, artifacts``.

    Takes events with ``kind, name, data``; each artifact is a struct ``name,
    data, from_planner``.
    """
    artifact = F.struct(
        F.col("name").alias("name"),
        F.col("data").alias("data"),
        (F.col("name") == PLANNER_ARTIFACT).alias("from_planner"),
    )
    return paged_list(
        events.filter(F.col("kind") == "artifact"), [context], seq, artifact, "artifacts", page_rows
    )


def join_parts(
    parts: DataFrame,
    key: str = "message_id",
    seq: str = "seq",
    agent: str = "agent_name",
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Final response of a message made of parts: ``key, page, response``.

    With text in the first part all texts are joined by newlines; otherwise the
    first function response counts, from whichever part holds it; otherwise an
    error text names the agent. Takes parts with ``text`` and
    ``function_response``.
    """
    text = F.nullif(F.col("text"), F.lit(""))
    keyed = parts.withColumn("_key", key_of([key]))
    heads = keyed.groupBy("_key").agg(
        F.min_by(text, seq).alias("_first"),
        F.min_by("function_response", F.when(F.col("function_response").isNotNull(), F.col(seq))).alias("_call"),
        F.min_by(agent, seq).alias("_agent"),
    )
    texts = paged_text(keyed.filter(text.isNotNull()), ["_key"], seq, text, "\n", "_text", page_rows)
    speaking = heads.filter(F.col("_first").isNotNull())
    spoken = speaking.join(texts, "_key").select(
        F.col("_key")[key].alias(key), "page", F.col("_text").alias("response")
    )
    other = heads.filter(F.col("_first").isNull()).select(
        F.col("_key")[key].alias(key),
        F.lit(0).alias("page"),
        F.coalesce(
            "_call", F.concat(F.lit("Error in running agent: "), F.coalesce("_agent", F.lit("")))
        ).alias("response"),
    )
    return spoken.unionByName(other)


def validate_edges(
    nodes: DataFrame, edges: DataFrame, node: str = "id", src: str = "src", dst: str = "dst"
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) edges; a rejected edge names an end that does not exist."""
    ids = nodes.select(node).filter(F.col(node).isNotNull()).distinct()
    starts = ids.select(F.col(node).alias(src), F.lit(True).alias("_start"))
    ends = ids.select(F.col(node).alias(dst), F.lit(True).alias("_end"))
    checked = skew_join(skew_join(edges, starts, [src], "left"), ends, [dst], "left")
    known = F.col("_start").isNotNull() & F.col("_end").isNotNull()
    valid = checked.filter(known).select(*edges.columns)
    rejected = checked.filter(~known).select(*edges.columns, F.lit("Invalid node IDs").alias("error"))
    return valid, rejected
