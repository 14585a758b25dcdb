"""Plan, message, graph and stream queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.fixtures import Fixtures
from agentlake.operators import graph, workflow
from agentlake.plans.catalog import query
from agentlake.plans.queries_cluster import WAIT_SECONDS
from agentlake.streaming.crashloop import stream_crashloop as crashloop_stream
from agentlake.streaming.status import stream_task_status as status_stream
from agentlake.streaming.truncate import stream_truncate as truncate_stream


@query(
    """select o_orderkey as plan_id, cast(i as int) as pos,
           case when i = 1 then 'planner' else cast(i - 1 as string) end as src, cast(i as string) as dst,
           concat('task ', cast(i as string), ' of ', cast(o_orderkey as string)) as description
    from orders join range(1, 4) t(i) on i <= o_orderkey % 3 + 1"""
)
def plan_edges(f: Fixtures) -> DataFrame:
    return workflow.plan_edges(f.plans)


@query(
    """select o_orderkey as plan_id, cast(i as int) as level,
           case when i = 0 then 'planner' else cast(i as string) end as node
    from orders join range(0, 4) t(i) on i <= o_orderkey % 3 + 1"""
)
def plan_order(f: Fixtures) -> DataFrame:
    """Every plan's nodes in order; all plans are one graph of many chains."""
    edges = workflow.plan_edges(f.plans)
    name = lambda end: F.struct("plan_id", F.col(end).alias("node"))
    chained = edges.select(name("src").alias("src"), name("dst").alias("dst"))
    ends = chained.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return graph.topo_order(ends, chained).select("id.plan_id", "level", "id.node")


_CUT = """ends as (select task_id, min(seq) as ending from task_items
                 where is_task_complete or require_user_input group by task_id),
    kept as (
        select task_id, seq, content,
               case when is_task_complete then 'complete' when require_user_input then 'input_required'
                    else 'working' end as outcome
        from task_items left join ends using (task_id) where ending is null or seq <= ending)"""


@query(f"with {_CUT} select * from kept", ("task_items",))
def truncate_at_terminal(f: Fixtures) -> DataFrame:
    return workflow.truncate_at_terminal(f.task_items).select("task_id", "seq", "content", "outcome")


_ISLANDS = """stepped as (
        select *, case when lag(seq) over w is null then 0
                       when context_id is distinct from lag(context_id) over w or lag(completed) over w then 1
                       else 0 end as step
        from messages window w as (partition by stream_id order by seq)),
    numbered as (
        select stream_id, seq, context_id, query, completed,
               cast(sum(step) over (partition by stream_id order by seq) as bigint) as island
        from stepped)"""


@query(f"with {_ISLANDS} select * from numbered", ("messages",))
def session_islands(f: Fixtures) -> DataFrame:
    return workflow.session_islands(f.messages)


@query(
    f"""with {_ISLANDS}
    select stream_id, island, page, string_agg(query, '; ' order by seq) as history
    from (select *, cast((row_number() over (partition by stream_id, island order by seq) - 1) // 5 as int) as page
          from numbered)
    group by stream_id, island, page""",
    ("messages",),
)
def session_history(f: Fixtures) -> DataFrame:
    pages = workflow.session_history(workflow.session_islands(f.messages), page_rows=5)
    return pages.withColumn("history", F.array_join("history", "; "))


@query(
    """select node_id, max_by(task_id, seq) filter (where task_id <> '') as task_id,
           max_by(context_id, seq) filter (where context_id <> '') as context_id,
           max_by(query, seq) filter (where query <> '') as query
    from node_updates group by node_id""",
    ("node_updates",),
)
def merge_attributes(f: Fixtures) -> DataFrame:
    return workflow.merge_attributes(f.node_updates, attributes=("task_id", "context_id", "query"))


@query(
    """select node_id, state, ts, seq from node_events
    qualify row_number() over (partition by node_id order by ts desc, seq desc) = 1""",
    ("node_events",),
)
def latest_status(f: Fixtures) -> DataFrame:
    return workflow.latest_status(f.node_events)


@query(
    """select context_id, 0 as page, count(*) as artifacts,
           count(*) filter (where name = 'PlannerAgent-result') as planned,
           string_agg(concat(name, '=', data), ';' order by seq) as content
    from artifacts where kind = 'artifact' group by context_id""",
    ("artifacts",),
)
def collect_artifacts(f: Fixtures) -> DataFrame:
    pages = workflow.collect_artifacts(f.artifacts)
    texts = F.transform("artifacts", lambda a: F.concat(a["name"], F.lit("="), a["data"]))
    planned = F.filter("artifacts", lambda a: a["from_planner"])
    return pages.select(
        "context_id",
        "page",
        F.size("artifacts").cast("long").alias("artifacts"),
        F.size(planned).cast("long").alias("planned"),
        F.array_join(texts, ";").alias("content"),
    )


@query(
    """with heads as (
        select message_id, min_by(coalesce(text, ''), seq) as head, any_value(agent_name) as agent,
               min_by(function_response, seq) filter (where function_response is not null) as called,
               string_agg(text, chr(10) order by seq) filter (where text <> '') as spoken
        from parts group by message_id)
    select message_id, 0 as page,
           case when head <> '' then spoken else coalesce(called, concat('Error in running agent: ', agent)) end
               as response
    from heads""",
    ("parts",),
)
def join_parts(f: Fixtures) -> DataFrame:
    return workflow.join_parts(f.parts)


@query(
    """select src, dst, not (src in (select id from nodes) and dst in (select id from nodes)) as rejected from edges""",
    ("edges", "nodes"),
)
def validate_edges(f: Fixtures) -> DataFrame:
    valid, rejected = workflow.validate_edges(f.nodes, f.edges)
    return valid.select("src", "dst", F.lit(False).alias("rejected")).unionByName(
        rejected.select("src", "dst", F.lit(True).alias("rejected"))
    )


@query(
    "select id, seq from nodes where id not in (select dst from valid_edges)", ("nodes", "edges", "valid_edges")
)
def roots(f: Fixtures) -> DataFrame:
    return graph.roots(f.nodes, f.valid_edges)


_REACH = """reach(id) as (
        select id from starts union select dst from reach join valid_edges on src = id)"""
# Longest path to every node: all (node, length) pairs, then the greatest.
_LEVELS = """lengths(id, level) as (
        select id, 0 from nodes where id not in (select dst from valid_edges)
        union select dst, level + 1 from lengths join valid_edges on src = id),
    placed as (select id, seq, max(level) as level from nodes join lengths using (id) group by id, seq)"""


@query(f"with recursive {_REACH} select id from reach", ("valid_edges", "starts"))
def descendants(f: Fixtures) -> DataFrame:
    return graph.descendants(f.valid_edges, graph.start_nodes(f.nodes, f.valid_edges, f.starts))


@query(f"with recursive {_LEVELS} select id, seq, level from placed", ("valid_edges",))
def topo_order(f: Fixtures) -> DataFrame:
    return graph.topo_order(f.nodes, f.valid_edges)


@query(
    f"with recursive {_LEVELS}, {_REACH} select id, seq, level from placed where id in (select id from reach)",
    ("valid_edges", "starts"),
)
def runnable(f: Fixtures) -> DataFrame:
    order = graph.topo_order(f.nodes, f.valid_edges)
    return graph.runnable(order, graph.descendants(f.valid_edges, f.starts))


_STATES = """pauses as (
        select node_id, min(seq) as pause_seq from outcomes
        where state = 'input_required' and context_id <> '' group by node_id),
    placed as (
        select o.*, pause_seq, row_number() over (partition by workflow_id order by level, seq, id) as place
        from node_order o left join pauses on node_id = id),
    stops as (select workflow_id, min(place) filter (where pause_seq is not null) as stop
              from placed group by workflow_id),
    states as (
        select workflow_id, id, level, seq, pause_seq,
               case when stop is null or place < stop then 'COMPLETED' when place = stop then 'PAUSED'
                    else 'READY' end as node_state,
               case when stop is null then 'COMPLETED' else 'PAUSED' end as workflow_state
        from placed join stops using (workflow_id))"""


@query(
    f"with {_STATES} select workflow_id, id, level, seq, node_state, workflow_state from states",
    ("node_order", "outcomes"),
)
def run_states(f: Fixtures) -> DataFrame:
    return graph.run_states(f.node_order, f.outcomes)


@query(
    f"""with {_STATES}
    select o.* from outcomes o join states s on s.id = o.node_id
    where node_state = 'COMPLETED' or (node_state = 'PAUSED' and o.seq <= pause_seq)""",
    ("node_order", "outcomes"),
)
def emitted_events(f: Fixtures) -> DataFrame:
    return graph.emitted_events(graph.run_states(f.node_order, f.outcomes), f.outcomes)


def _event_stream(f: Fixtures) -> DataFrame:
    """The events table as a stream.

    The path is a pattern: a stream reads folders and patterns, no single file,
    and the table may be either.
    """
    path = f"{f.folder.rstrip('/')}/events.parque[t]"
    return f.spark.readStream.schema(f.tables["events"].schema).parquet(path)


@query(
    """with segments as (
        select *, sum((kind = 'message')::int) over (partition by task_id order by seq) as segment
        from status_events),
    stopped as (
        select *, min(case when kind = 'completed' or (kind = 'input_required' and context_id is not null)
                           then seq end) over (partition by task_id, segment) as stop
        from segments),
    named as (
        select *, max(case when seq = stop then kind end) over (partition by task_id, segment) as stop_kind
        from stopped)
    select task_id, seq,
           case when stop is null or seq < stop then 'RUNNING' when stop_kind = 'completed' then 'COMPLETED'
                else 'PAUSED' end as state,
           stop is null or seq <= stop as emitted
    from named""",
    ("status_events",),
)
def stream_task_status(f: Fixtures) -> DataFrame:
    events = _event_stream(f)
    kind = (
        F.when(F.col("event_type") == "signup", F.lit("message"))
        .when(F.col("event_type") == "error", F.lit("input_required"))
        .when(F.col("event_type") == "purchase", F.lit("completed"))
        .otherwise(F.lit("working"))
    )
    context = F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("ctx-"), F.col("user_id").cast("string")))
    rows = events.select(
        F.col("user_id").alias("task_id"), F.col("event_id").alias("seq"), kind.alias("kind"), context.alias("context_id")
    )
    return status_stream(rows)


@query(f"with {_CUT} select * from kept", ("task_items",))
def stream_truncate(f: Fixtures) -> DataFrame:
    rows = _event_stream(f).select(
        F.col("user_id").alias("task_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("content"),
        (F.col("event_id") % 29 == 0).alias("is_task_complete"),
        (F.col("event_id") % 23 == 0).alias("require_user_input"),
    )
    return truncate_stream(rows)


@query(
    """with judged as (
        select task_id, seq, content, case when seq % 7 = 0 then null else is_task_complete end as flagged,
               require_user_input
        from task_items),
    told as (select *, case when coalesce(flagged, true) then 'complete' when require_user_input then 'input_required'
                            else 'working' end as outcome from judged),
    ends as (select task_id, min(seq) as until from told where outcome <> 'working' group by task_id)
    select task_id, seq, content, outcome from told left join ends using (task_id)
    where until is null or seq <= until""",
    ("task_items",),
)
def truncate_at_text(f: Fixtures) -> DataFrame:
    """Every seventh item is plain text, which has no flag and completes its task."""
    flag = F.when(F.col("seq") % 7 != 0, F.col("is_task_complete"))
    items = f.task_items.withColumn("is_task_complete", flag)
    return workflow.truncate_at_terminal(items, text_completes=True).select("task_id", "seq", "content", "outcome")


# A deploy nobody answers is settled once the watermark passes its timeout.
@query(
    """with settled as (
        select max(ts) - interval 1 second as mark from (
            select ts from deploys union all select ts from pod_status where waiting_reason = 'CrashLoopBackOff')),
    answered as (
        select d.namespace, d.pod, d.event_id, d.ts, min(s.ts) as crashed_at
        from deploys d left join pod_status s on s.namespace = d.namespace and s.pod = d.pod
             and s.waiting_reason = 'CrashLoopBackOff' and s.ts >= d.ts and s.ts < d.ts + interval 2 day
        group by d.namespace, d.pod, d.event_id, d.ts)
    select namespace, pod, ts, crashed_at is not null as crashed, crashed_at
    from answered, settled
    where crashed_at is not null or date_trunc('millisecond', ts + interval 2 day) + interval 1 millisecond
          <= date_trunc('millisecond', mark)""",
    ("deploys", "pod_status"),
)
def stream_crashloop(f: Fixtures) -> DataFrame:
    nation = f.tables["nation"]
    events = _event_stream(f)
    named = events.join(nation, events["user_id"] % 25 == nation["n_nationkey"]).select(
        F.col("n_name").alias("namespace"),
        F.concat(F.lit("pod-"), F.col("user_id").cast("string")).alias("pod"),
        "ts",
        "event_type",
    )
    deploys = named.filter(F.col("event_type") == "signup")
    status = named.filter(F.col("event_type") == "error").withColumn("waiting_reason", F.lit("CrashLoopBackOff"))
    return crashloop_stream(status, deploys, WAIT_SECONDS)
