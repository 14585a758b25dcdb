from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agentlake.operators import graph, workflow

RUN = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
ITEM = "task_id long, seq long, content string, is_task_complete boolean, require_user_input boolean"


def test_plan_chain(spark, rows):
    plans = spark.createDataFrame(
        [(1, [(1, "air", "pending"), (2, "hotel", "pending"), (3, "car", "pending")]), (2, [])],
        "plan_id long, tasks array<struct<id:int,description:string,status:string>>",
    )
    assert rows(workflow.plan_edges(plans), "plan_id", "src", "dst", "description") == [
        (1, "1", "2", "hotel"), (1, "2", "3", "car"), (1, "planner", "1", "air"),
    ]


flags = st.tuples(st.booleans() | st.none(), st.booleans() | st.none())


@RUN
@given(st.lists(st.lists(flags, max_size=6), min_size=3, max_size=12))
def test_truncation_stops_at_the_first_terminal_item(spark, tasks):
    data = [(t, s, "c", c, a) for t, items in enumerate(tasks) for s, (c, a) in enumerate(items)]
    found = workflow.truncate_at_terminal(spark.createDataFrame(data, ITEM))
    want = []
    for t, items in enumerate(tasks):
        for s, (complete, ask) in enumerate(items):
            outcome = "complete" if complete else "input_required" if ask else "working"
            want.append((t, s, outcome))
            if outcome != "working":
                break
    assert sorted((r.task_id, r.seq, r.outcome) for r in found.collect()) == want


def test_plain_text_may_complete(spark):
    df = spark.createDataFrame([(1, 1, "text", None, None), (1, 2, "late", None, None)], ITEM)
    kept = workflow.truncate_at_terminal(df, text_completes=True).collect()
    assert [(r.seq, r.outcome) for r in kept] == [(1, "complete")]


contexts = st.sampled_from(["a", "b", None])


@RUN
@given(st.lists(st.tuples(contexts, st.booleans() | st.none()), min_size=1, max_size=40), st.integers(1, 7))
def test_islands_across_blocks(spark, messages, block):
    data = [("s", i * 3, context, f"q{i}", done) for i, (context, done) in enumerate(messages)]
    df = spark.createDataFrame(data, "stream_id string, seq long, context_id string, query string, completed boolean")
    found = workflow.session_islands(df, block_rows=block).orderBy("seq").collect()
    want, island = [], 0
    for i, (context, _) in enumerate(messages):
        if i and (context != messages[i - 1][0] or messages[i - 1][1]):
            island += 1
        want.append(island)
    assert [r.island for r in found] == want


def test_history_of_islands(spark, rows):
    df = spark.createDataFrame(
        [("s", 1, "a", "one", False), ("s", 2, "a", "two", True), ("s", 3, "a", "three", False)],
        "stream_id string, seq long, context_id string, query string, completed boolean",
    )
    history = workflow.session_history(workflow.session_islands(df))
    assert [(r.island, r.history) for r in history.orderBy("island").collect()] == [(0, ["one", "two"]), (1, ["three"])]


def test_attributes_and_status(spark, rows):
    updates = spark.createDataFrame(
        [("n", 1, "t1", "c1"), ("n", 2, "", None), ("n", 3, None, "c3"), ("m", 1, None, "")],
        "node_id string, seq long, task_id string, context_id string",
    )
    assert rows(workflow.merge_attributes(updates, attributes=("task_id", "context_id"))) == [("m", None, None), ("n", "t1", "c3")]
    events = spark.createDataFrame(
        [("n", 5, 1, "READY"), ("n", 5, 2, "RUNNING"), ("n", 4, 9, "PAUSED")], "node_id string, ts int, seq long, state string"
    )
    assert rows(workflow.latest_status(events), "node_id", "state") == [("n", "RUNNING")]


def test_artifacts(spark):
    events = spark.createDataFrame(
        [("c", 2, "artifact", "HotelAgent-result", "h"), ("c", 1, "artifact", "PlannerAgent-result", "p"), ("c", 3, "status", "x", "y")],
        "context_id string, seq long, kind string, name string, data string",
    )
    found = workflow.collect_artifacts(events).first()
    assert [(a.name, a.data, a.from_planner) for a in found.artifacts] == [
        ("PlannerAgent-result", "p", True), ("HotelAgent-result", "h", False),
    ]


def test_message_parts(spark):
    parts = spark.createDataFrame(
        [
            (1, 1, "A", "x", None), (1, 2, "A", "", None), (1, 3, "A", "y", "call"),
            (2, 1, "A", "", None), (2, 2, "A", "late text", None), (2, 3, "A", None, "call"),
            (3, 1, "B", None, None),
        ],
        "message_id long, seq long, agent_name string, text string, function_response string",
    )
    found = {r.message_id: r.response for r in workflow.join_parts(parts).collect()}
    assert found == {1: "x\ny", 2: "call", 3: "Error in running agent: B"}


def nodes_of(spark, ids):
    return spark.createDataFrame([(i, i) for i in ids], "id long, seq long")


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def test_edges_are_checked(spark, rows):
    valid, rejected = workflow.validate_edges(nodes_of(spark, [1, 2]), edges_of(spark, [(1, 2), (2, 3), (9, 1), (None, 1)]))
    assert rows(valid) == [(1, 2)]
    assert rows(rejected, "src", "dst") == [(None, 1), (2, 3), (9, 1)]


def test_roots_and_starts(spark, rows):
    nodes, edges = nodes_of(spark, [1, 2, 3, 4]), edges_of(spark, [(1, 2), (2, 3)])
    assert rows(graph.roots(nodes, edges), "id") == [(1,), (4,)]
    assert rows(graph.start_nodes(nodes, edges, spark.createDataFrame([(3,)], "id long")), "id") == [(3,)]
    assert rows(graph.start_nodes(nodes, edges, spark.createDataFrame([(77,)], "id long")), "id") == [(1,), (4,)]


def test_reach_survives_cycles(spark, rows):
    edges = edges_of(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (8, 9)])
    assert rows(graph.descendants(edges, spark.createDataFrame([(2,)], "id long"))) == [(1,), (2,), (3,), (4,)]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)).filter(lambda e: e[0] < e[1]), max_size=14))
def test_order_respects_every_edge(spark, pairs):
    order = graph.topo_order(nodes_of(spark, range(10)), edges_of(spark, pairs))
    level = {r.id: r.level for r in order.collect()}
    longest = {}
    for node in range(10):
        longest[node] = max((longest[s] + 1 for s, d in pairs if d == node), default=0)
    assert level == longest


def test_cycles_are_refused(spark):
    with pytest.raises(graph.CycleError):
        graph.topo_order(nodes_of(spark, [1, 2, 3]), edges_of(spark, [(1, 2), (2, 3), (3, 2)]))
    with pytest.raises(graph.CycleError):
        graph.topo_order(nodes_of(spark, [1, 2]), edges_of(spark, [(1, 2), (2, 1)]))


def test_run_stops_at_the_first_pause(spark, rows):
    order = spark.createDataFrame(
        [("w", 1, 0, 1), ("w", 2, 1, 2), ("w", 3, 2, 3), ("v", 4, 0, 4)], "workflow_id string, id long, level int, seq long"
    )
    outcomes = spark.createDataFrame(
        [(1, 1, "working", "c"), (1, 2, "input_required", None), (2, 3, "working", "c"), (2, 4, "input_required", "c"),
         (2, 5, "working", "c"), (3, 6, "working", "c"), (4, 7, "input_required", "")],
        "node_id long, seq long, state string, context_id string",
    )
    states = graph.run_states(order, outcomes)
    assert rows(states, "workflow_id", "id", "node_state", "workflow_state") == [
        ("v", 4, "COMPLETED", "COMPLETED"),
        ("w", 1, "COMPLETED", "PAUSED"),
        ("w", 2, "PAUSED", "PAUSED"),
        ("w", 3, "READY", "PAUSED"),
    ]
    assert rows(graph.emitted_events(states, outcomes), "seq") == [(1,), (2,), (3,), (4,), (7,)]


def test_runnable_keeps_the_order(spark):
    order = spark.createDataFrame([(1, 1, 0), (2, 2, 2), (3, 3, 1)], "id long, seq long, level int")
    assert [r.id for r in graph.runnable(order, order.filter(F.col("id") > 1).select("id")).collect()] == [3, 2]


def rounds_of(monkeypatch, prefix):
    """Counts the tables of a graph loop that start with ``prefix`` and a number."""
    names, original = [], graph.written

    def counted(df, name, *rest):
        names.append(name)
        return original(df, name, *rest)

    monkeypatch.setattr(graph, "written", counted)
    return lambda: sum(n.removeprefix(prefix).isdigit() for n in names)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n = 2_000
    chain = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    nodes = spark.range(n + 1).select("id", F.col("id").alias("seq"))
    count = rounds_of(monkeypatch, "order")
    levels = {r.id: r.level for r in graph.topo_order(nodes, chain).collect()}
    assert levels == {i: i for i in range(n + 1)} and count() <= 30
    count = rounds_of(monkeypatch, "reach")
    starts = spark.createDataFrame([(700,)], "id long")
    found = sorted(r.id for r in graph.descendants(chain, starts).collect())
    assert found == list(range(700, n + 1)) and count() <= 30


@pytest.mark.parametrize("seed,plain", [(1, 0), (2, 0), (3, 2), (4, 5)])
def test_random_graphs(spark, seed, plain):
    """Text ids, several edges in, detours of different lengths, and circles."""
    rng = random.Random(seed)
    n = 60
    pairs = {(a, rng.randint(a + 1, min(n - 1, a + 4))) for a in range(n - 1) for _ in range(rng.choice([0, 1, 1, 2]))}
    name = "n{:02}".format
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "src string, dst string")
    longest = {}
    for v in range(n):
        longest[v] = max((longest[a] + 1 for a, b in pairs if b == v), default=0)
    nodes = spark.createDataFrame([(name(i), i) for i in range(n)], "id string, seq long")
    assert {r.id: r.level for r in graph.topo_order(nodes, edges, plain).collect()} == {name(v): d for v, d in longest.items()}
    back = pairs | {(rng.randint(20, n - 1), rng.randint(0, 40)) for _ in range(6)}
    looped = spark.createDataFrame([(name(a), name(b)) for a, b in back], "src string, dst string")
    wanted = rng.sample(range(n), 2)
    reach, todo = set(wanted), list(wanted)
    while todo:
        u = todo.pop()
        new = {b for a, b in back if a == u} - reach
        reach |= new
        todo += new
    starts = spark.createDataFrame([(name(i),) for i in wanted], "id string")
    assert sorted(r.id for r in graph.descendants(looped, starts, plain).collect()) == sorted(map(name, reach))


def test_circles_are_refused_however_long(spark):
    ring = [(i, (i + 1) % 9 + 10 * (i // 10)) for i in range(9)]
    for pairs in (ring, [(50, 0), *ring], [*ring, (3, 60), (60, 61)], [(1, 1)]):
        ids = {i for pair in pairs for i in pair}
        with pytest.raises(graph.CycleError):
            graph.topo_order(nodes_of(spark, sorted(ids)), edges_of(spark, pairs), plain_rounds=0)
    found = graph.descendants(edges_of(spark, [*ring, (70, 71)]), spark.createDataFrame([(70,)], "id long"), 0)
    assert sorted(r.id for r in found.collect()) == [70, 71]


def test_an_edge_is_followed_once(spark, monkeypatch):
    """Later rounds read only edges that are still to be followed, also where ids have several fields."""
    sizes, original = [], graph.written

    def counted(df, name, *rest):
        kept = original(df, name, *rest)
        sizes.extend([kept[0].count()] if name == "split" else [])
        return kept

    monkeypatch.setattr(graph, "written", counted)
    pairs = [((p, i), (p, i + 1)) for p in range(20) for i in range(p % 4)]
    edges = spark.createDataFrame(pairs, "src struct<plan:long,node:int>, dst struct<plan:long,node:int>")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    assert all(r.level == r.id.node for r in graph.topo_order(nodes, edges).collect())
    assert sizes == [30, 15, 5, 0]
