"""Streams fed in several batches give what the batch rules give."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from agentlake.operators import waits, workflow
from agentlake.streaming import folded, status
from agentlake.streaming.crashloop import stream_crashloop
from agentlake.streaming.status import next_state, stream_task_status
from agentlake.streaming.truncate import stream_truncate


def as_stream(spark, tmp_path, batches, schema, number=0):
    """One file per batch, read one file at a time."""
    folder = tmp_path / "in"
    for i, batch in enumerate(batches, number):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(folder))
        # Files are taken by modification time.
        newest = max(folder.glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
        stamp = 1_700_000_000 + i
        os.utime(newest, (stamp, stamp))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_status_is_resumable(spark, tmp_path):
    schema = "task_id long, seq long, kind string, context_id string"
    batches = [
        [(1, 1, "message", "c"), (1, 2, "working", "c"), (1, 3, "input_required", "c"), (2, 1, "message", "c")],
        [(1, 4, "working", "c"), (2, 2, "input_required", None), (2, 3, "completed", "c")],
        [(1, 5, "message", "c"), (1, 6, "completed", None), (1, 7, "working", "c"), (2, 4, "working", "c")],
    ]
    found = stream_task_status(as_stream(spark, tmp_path, batches, schema)).collect()
    assert sorted((r.task_id, r.seq, r.state, r.emitted) for r in found) == [
        (1, 1, "RUNNING", True), (1, 2, "RUNNING", True), (1, 3, "PAUSED", True), (1, 4, "PAUSED", False),
        (1, 5, "RUNNING", True), (1, 6, "COMPLETED", True), (1, 7, "COMPLETED", False),
        (2, 1, "RUNNING", True), (2, 2, "RUNNING", True), (2, 3, "COMPLETED", True), (2, 4, "COMPLETED", False),
    ]
    assert next_state("READY", "working", False) == ("RUNNING", True)


def test_truncation_equals_batch(spark, tmp_path):
    schema = "task_id long, seq long, content string, is_task_complete boolean, require_user_input boolean"
    data = [(t, s, f"{t}.{s}", (t * s) % 7 == 6, (t + s) % 11 == 10) for s in range(12) for t in range(6)]
    batches = [data[:20], data[20:50], data[50:]]
    found = stream_truncate(as_stream(spark, tmp_path, batches, schema))
    batch = workflow.truncate_at_terminal(spark.createDataFrame(data, schema))
    columns = ("task_id", "seq", "content", "outcome")
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))


def test_truncation_forgets_closed_tasks(spark, tmp_path):
    schema = "task_id string, seq long, content string, is_task_complete boolean, require_user_input boolean"
    batches = [[("x", 1, "a", True, False), ("x", 2, "b", False, False)], [("x", 3, "c", False, False)]]
    found = stream_truncate(as_stream(spark, tmp_path, batches, schema), ttl_ms=3_600_000)
    assert [r.seq for r in found.collect()] == [1]
    found = stream_truncate(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), ttl_ms=0)
    assert sorted(r.seq for r in found.collect()) == [1, 3]


def plain_status(events):
    states, out = {}, []
    for task, seq, kind, context in sorted(events, key=lambda e: e[1]):
        states[task], emitted = next_state(states.get(task, "READY"), kind, bool(context))
        out.append((task, seq, states[task], emitted))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def random_events(rng, n):
    """Text ids and a NULL one; one task owns a third of all events."""
    kinds = ["working"] * 4 + ["input_required", "completed", "message", None]
    tasks = ["hot"] * 5 + ["a-1", "a-2", "b", "c", "d", "e", "f", "g", None]
    return [(rng.choice(tasks), i, rng.choice(kinds), rng.choice(["c", "", None])) for i in range(n)]


@pytest.mark.parametrize("block_rows", [1, 3, 7, 100_000])
def test_blocks_of_a_task_compose(spark, block_rows):
    events = random_events(random.Random(block_rows), 400)
    table = spark.createDataFrame(events, "task_id string, seq long, kind string, context_id string").repartition(5)
    none = spark.createDataFrame([], "task_id string, state string")
    assert in_order(status.fold_status(table, none, block_rows).collect()) == plain_status(events)
    first = plain_status(events[:150])
    left = spark.createDataFrame(list({task: state for task, _, state, _ in first}.items()), "task_id string, state string")
    rest = status.fold_status(table.filter("seq >= 150"), left, block_rows).collect()
    assert in_order(rest) == plain_status(events)[150:]


def test_status_of_many_batches_and_runs(spark, tmp_path, monkeypatch):
    """Whole states every third batch; a second run goes on from the first."""
    monkeypatch.setattr(folded, "WHOLE_EVERY", 3)
    schema = "task_id string, seq long, kind string, context_id string"
    events, path = random_events(random.Random(5), 320), str(tmp_path / "kept")
    batches = [events[i : i + 40] for i in range(0, 320, 40)]
    found = stream_task_status(as_stream(spark, tmp_path, batches[:5], schema), path)
    assert in_order(found.collect()) == plain_status(events[:200])
    found = stream_task_status(as_stream(spark, tmp_path, batches[5:], schema, 5), path)
    assert in_order(found.collect()) == plain_status(events)


def test_no_python_worker_folds_status(spark):
    table = spark.createDataFrame([("t", 1, "message", "c")], "task_id string, seq long, kind string, context_id string")
    plan = status.fold_status(table, spark.createDataFrame([], "task_id string, state string"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_crashloop_equals_batch(spark, tmp_path):
    schema = "namespace string, pod string, at long, kind string"
    data = [
        ("n", "a", 0, "deploy"), ("n", "a", 59, "crash"), ("n", "b", 10, "deploy"), ("n", "b", 70, "crash"),
        ("n", "c", 20, "deploy"), ("n", "a", 80, "deploy"), ("n", "a", 80, "crash"), ("n", "d", 100, "crash"),
        ("n", "d", 101, "deploy"), ("n", "e", 1000, "crash"),
    ]
    rows = as_stream(spark, tmp_path, [data[:3], data[3:6], data[6:9], data[9:]], schema)
    named = rows.select("namespace", "pod", F.timestamp_seconds(F.col("at") + 1_700_000_000).alias("ts"), "kind")
    crash = F.when(F.col("kind") == "crash", F.lit(waits.CRASHLOOP)).alias("waiting_reason")
    status = named.filter("kind = 'crash'").select("namespace", "pod", "ts", crash)
    deploys = named.filter("kind = 'deploy'").select("namespace", "pod", "ts")
    found = stream_crashloop(status, deploys, 60)

    table = spark.createDataFrame(data, schema).select("namespace", "pod", F.timestamp_seconds(F.col("at") + 1_700_000_000).alias("ts"), "kind")
    batch = waits.crashloop_wait(
        table.filter("kind = 'crash'").select("namespace", "pod", "ts", crash),
        table.filter("kind = 'deploy'").select("namespace", "pod", "ts"),
    )
    columns = ("namespace", "pod", "ts", "crashed", "crashed_at")
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
    assert found.filter("crashed").count() == 2


def test_crashloop_over_many_batches_and_runs(spark, tmp_path):
    """One pod owns a third of the rows; text and number keys; two runs on one path."""
    draw = random.Random(2)
    moments = sorted(
        (draw.randint(0, 4000), "hot" if draw.random() < 0.35 else f"p{draw.randint(0, 9)}", draw.choice(["crash", "deploy", "deploy"]))
        for _ in range(600)
    )
    schema, path = "namespace long, pod string, at long, kind string", str(tmp_path / "kept")
    data = [(1, pod, at, kind) for at, pod, kind in moments] + [(2, "last", 9000, "crash")]
    crash = F.lit(waits.CRASHLOOP).alias("waiting_reason")

    def split(df):
        named = df.select("namespace", "pod", F.timestamp_seconds(F.col("at") + 1_700_000_000).alias("ts"), "kind")
        return (
            named.filter("kind = 'crash'").select("namespace", "pod", "ts", crash),
            named.filter("kind = 'deploy'").select("namespace", "pod", "ts"),
        )

    batches = [data[i : i + 100] for i in range(0, len(data), 100)]
    first = stream_crashloop(*split(as_stream(spark, tmp_path, batches[:3], schema)), 60, path=path).count()
    found = stream_crashloop(*split(as_stream(spark, tmp_path, batches[3:], schema, 3)), 60, path=path)
    assert 0 < first < found.count() == sum(kind == "deploy" for _, _, _, kind in data)
    batch = waits.crashloop_wait(*split(spark.createDataFrame(data, schema)))
    columns = ("namespace", "pod", "ts", "crashed", "crashed_at")
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))


def test_late_and_undated_moments(spark, tmp_path):
    schema = "namespace string, pod string, at long, kind string"
    batches = [
        [("n", "a", 0, "deploy"), ("n", "b", 5, "deploy"), ("n", None, 6, "deploy"), ("n", "b", None, "deploy")],
        [("n", "a", 100, "deploy"), ("n", None, 7, "crash")],
        [("n", "a", 3, "crash"), ("n", "b", 98, "deploy"), ("n", "c", 200, "crash")],
    ]
    rows = as_stream(spark, tmp_path, batches, schema)
    named = rows.select("namespace", "pod", F.timestamp_seconds("at").alias("ts"), "kind")
    status = named.filter("kind = 'crash'").withColumn("waiting_reason", F.lit(waits.CRASHLOOP)).drop("kind")
    found = stream_crashloop(status, named.filter("kind = 'deploy'").drop("kind"), 60)
    told = sorted((r.pod or "", int(r.ts.timestamp()), r.crashed) for r in found.collect())
    assert told == [("", 6, True), ("a", 0, False), ("a", 100, False), ("b", 5, False), ("b", 98, False)]
