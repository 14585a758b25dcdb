"""Task graphs held as ``nodes(id, seq)`` and ``edges(src, dst)``.

Iterative operators keep each round as a table in the shared folder, so plans
stay short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.operators.paging import skew_join
from agentlake.session import written


#: Levels walked one at a time, which touches only the edges of the newest nodes,
#: before rounds that halve what is left of the depth. Both give the same rows.
PLAIN_ROUNDS = 14


class CycleError(ValueError):
    """The graph has no topological order."""


def roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes no edge leads to."""
    return nodes.join(edges.select(F.col("dst").alias("id")).distinct(), "id", "left_anti")


def start_nodes(nodes: DataFrame, edges: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The wanted nodes (``id``) that exist, or the roots when there are none."""
    if wanted is not None:
        known = nodes.join(wanted.select("id").distinct(), "id", "left_semi")
        if not known.isEmpty():
            return known
    return roots(nodes, edges)


def descendants(edges: DataFrame, starts: DataFrame, plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """Start nodes and every node reachable from them: distinct ``id``.

    The first ``plain_rounds`` follow the edges of the newest nodes. What is
    deeper takes as many rounds as the depth of chains and trees has bits.
    """
    spark = edges.sparkSession
    edges, _, _ = written(edges.select("src", "dst").distinct(), "edges")
    newest, path, more = written(starts.select("id").distinct(), "reach0")
    schema, paths = newest.schema, [path]
    while more and len(paths) <= plain_rounds:
        seen = spark.read.schema(schema).parquet(*paths)
        found = (
            edges.join(newest.select(F.col("id").alias("src")), "src", "left_semi")
            .select(F.col("dst").alias("id"))
            .distinct()
            .join(seen, "id", "left_anti")
        )
        newest, path, more = written(found, f"reach{len(paths)}")
        paths.append(path)
    seen = spark.read.schema(schema).parquet(*paths)
    return _deeper(edges, seen, newest, len(paths)) if more else seen


def _deeper(edges: DataFrame, seen: DataFrame, newest: DataFrame, rounds: int) -> DataFrame:
    """``seen`` and all that ``newest`` of them lead to.

    A round does two things to every edge that is still open. Where its source
    was reached, its target is. Where its source has one way in, the edge moves
    up to the source's own source, so the stretch it stands for doubles. Edges
    out of sources that nothing leads to any more are dropped, as are those into
    reached nodes; two rounds without a new node are the end.
    """
    way = edges.filter("src IS DISTINCT FROM dst").join(seen.select(F.col("id").alias("dst")), "dst", "left_anti")
    # Of the edges out of reached nodes only those of the newest are still to be followed.
    steps, _, more = written(way.select("src", "dst", F.lit(False).alias("hit")), "reach-steps")
    last = newest.select("id", F.lit(True).alias("hit"), F.lit(None).cast(steps.schema["src"].dataType).alias("parent"))
    found, found_before = True, False
    while more and (found or found_before):
        found_before = found
        judged = (
            steps.groupBy(F.col("dst").alias("id"))
            .agg(F.max("hit").alias("hit"), F.min("src").alias("low"), F.max("src").alias("high"))
            .select("id", "hit", F.when(F.col("low") == F.col("high"), F.col("low")).alias("parent"))
        )
        # A node whose only way in comes from a reached one is reached as well. An
        # edge may have moved to a node that was reached that way a round before.
        reached = judged.filter("hit").unionByName(last).select(F.col("id").alias("parent"), F.lit(True).alias("_above"))
        current, _, found = written(
            skew_join(judged, reached, ["parent"], "left").select(
                "id", (F.col("hit") | F.col("_above").isNotNull()).alias("hit"), "parent"
            ),
            f"reach{rounds}",
            F.col("hit"),
        )
        hit = current.filter("hit").select("id")
        seen = seen.unionByName(hit)
        open_edges = steps.filter("src IS NOT NULL").select("src", "dst").join(hit.withColumnRenamed("id", "dst"), "dst", "left_anti")
        lookup = current.unionByName(last).select(F.col("id").alias("src"), F.col("hit").alias("_hit"), "parent")
        moved = skew_join(open_edges, lookup, ["src"]).select(
            F.when(~F.col("_hit"), F.coalesce("parent", "src")).alias("src"), "dst", F.col("_hit").alias("hit")
        )
        steps, _, more = written(moved.filter("src IS NULL OR src IS DISTINCT FROM dst"), f"reach-steps{rounds}")
        last, rounds = current.filter("hit"), rounds + 1
    return seen


def topo_order(nodes: DataFrame, edges: DataFrame, plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """Add ``level``: the longest path from a root; order by ``level, seq``.

    Raises ``CycleError`` when some nodes can never be reached in order. The
    first ``plain_rounds`` touch the edges of the nodes levelled in the round
    before, and the nodes that still wait for others. What is deeper takes as
    many rounds as the depth of chains and trees has bits.
    """
    spark = nodes.sparkSession
    # Ids may have several fields, which are slow to sort; a hash before them decides nearly all comparisons.
    code = F.xxhash64("id").alias("_code")
    nodes, _, _ = written(nodes.withColumn("_code", code), "all-nodes")
    distinct, _, _ = written(edges.select("src", "dst").distinct(), "all-edges")
    into = distinct.select(F.xxhash64("dst").alias("_code"), F.col("dst").alias("id"), F.lit(1).cast("long").alias("need"), F.lit(False).alias("node"))
    listed = nodes.select("_code", "id", F.lit(0).cast("long").alias("need"), F.lit(True).alias("node"))
    needs, _, _ = written(
        into.unionByName(listed).groupBy("_code", "id").agg(F.sum("need").alias("need"), F.max("node").alias("node")), "needs"
    )
    waiting_for = needs.filter("need > 0").select("_code", "id", "need")
    by_target = distinct.withColumns({"id": F.col("dst"), "_code": F.xxhash64("dst")}).join(waiting_for, ["_code", "id"])
    left, _, _ = written(by_target.select("src", "dst", "need", F.xxhash64("src").alias("_code")), "weighted")
    weighted = left.select("src", "dst")
    first = needs.filter("need = 0 AND node").select("id", "need", F.lit(0).cast("long").alias("met"), F.lit(0).cast("long").alias("level"))
    current, path, more = written(first, "order0")
    schema, paths = current.schema, [path]
    while more and len(paths) <= plain_rounds:
        ready = current.filter("met = need").select(code, F.col("id").alias("src"), F.lit(True).alias("_hit"))
        waiting = current.filter("met < need").select("id", "need", "met")
        # An edge is followed once, so later rounds read only those still to be followed.
        split, _, _ = written(left.join(ready, ["_code", "src"], "left").select("src", "dst", "need", "_code", "_hit"), "split")
        left = split.filter("_hit IS NULL").drop("_hit")
        met = split.filter("_hit").select(F.col("dst").alias("id"), "need", F.lit(1).cast("long").alias("met"))
        counted = (
            met.unionByName(waiting)
            .groupBy("id")
            .agg(F.max("need").alias("need"), F.sum("met").alias("met"))
            .withColumn("level", F.lit(len(paths)).cast("long"))
        )
        current, path, more = written(counted, f"order{len(paths)}", F.col("met") == F.col("need"))
        paths.append(path)
    levels = spark.read.schema(schema).parquet(*paths).filter("met = need").select("id", "level")
    if more:
        levels = _longest(weighted, levels, len(paths))
    others = [c for c in nodes.columns if c not in ("id", "_code")]
    ordered, _, waits = written(
        nodes.join(levels.withColumn("_code", code), ["_code", "id"], "left").select("id", *others, F.col("level").cast("int").alias("level")),
        "ordered",
        F.col("level").isNull(),
    )
    if waits:
        raise CycleError("graph contains a cycle")
    return ordered


def _longest(edges: DataFrame, levels: DataFrame, rounds: int) -> DataFrame:
    """``levels`` and those of all other nodes that can be levelled.

    A node's level is the greatest of a base and, for each open edge, the
    source's level plus the edge's length. A round folds edges out of levelled
    nodes into the base of their target. Where a source has one open way in, the
    edge moves up to that way's source and grows by its length, and the base
    goes along: max-plus steps compose, so what an edge stands for doubles. A
    round that levels no node is the end; nodes left then wait for a cycle.
    """
    long = lambda value: F.lit(value).cast("long")
    waiting = edges.join(levels.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst")
    known = levels.select(F.col("id").alias("src"), "level")
    nowhere = F.lit(None).cast(edges.schema["src"].dataType)
    folded = F.col("level").isNotNull()
    steps, _, more = written(
        skew_join(waiting, known, ["src"], "left").select(
            F.when(folded, nowhere).otherwise(F.col("src")).alias("src"),
            "dst",
            F.when(~folded, long(1)).alias("length"),
            (F.col("level") + 1).alias("base"),
        ),
        "order-steps",
        F.lit(True),
    )
    last = levels.limit(0).select("id", F.col("level").alias("base"), nowhere.alias("parent"), long(None).alias("up"), F.lit(True).alias("done"))
    some = True
    while more and some:
        # A node is levelled once no edge into it is open.
        judged = (
            steps.groupBy(F.col("dst").alias("id"))
            .agg(
                F.max("base").alias("base"), F.min("src").alias("low"), F.max("src").alias("high"), F.max("length").alias("up")
            )
            .select(
                "id",
                "base",
                F.when(F.col("low") == F.col("high"), F.col("low")).alias("parent"),
                "up",
                F.col("low").isNull().alias("done"),
            )
        )
        # A node whose only open way comes from a levelled one is levelled as well. An
        # edge may have moved to a node that was levelled that way a round before.
        above = judged.filter("done").unionByName(last).select(F.col("id").alias("parent"), F.col("base").alias("_above"))
        settled = F.greatest("base", F.col("_above") + F.col("up"))
        current, _, some = written(
            skew_join(judged, above, ["parent"], "left").select(
                "id",
                F.when(F.col("_above").isNotNull(), settled).otherwise(F.col("base")).alias("base"),
                F.when(F.col("_above").isNull(), F.col("parent")).alias("parent"),
                "up",
                (F.col("done") | F.col("_above").isNotNull()).alias("done"),
            ),
            f"order{rounds}",
            F.col("done"),
        )
        finished = current.filter("done")
        levels = levels.unionByName(finished.select("id", F.col("base").alias("level")))
        lookup = current.unionByName(last).select(F.col("id").alias("src"), F.col("base").alias("_base"), "parent", "up", "done")
        open_edges = steps.filter("src IS NOT NULL").select("src", "dst", "length")
        open_edges = open_edges.join(finished.select(F.col("id").alias("dst")), "dst", "left_anti")
        done, jumps = F.coalesce("done", F.lit(False)), F.col("parent").isNotNull()
        moved = skew_join(open_edges, lookup, ["src"], "left").select(
            F.when(done, nowhere).when(jumps, F.col("parent")).otherwise(F.col("src")).alias("src"),
            "dst",
            F.when(~done, F.when(jumps, F.col("length") + F.col("up")).otherwise(F.col("length"))).alias("length"),
            F.when(done | jumps, F.col("_base") + F.col("length")).alias("base"),
        )
        kept = current.filter("NOT done AND base IS NOT NULL").select(nowhere.alias("src"), F.col("id").alias("dst"), long(None).alias("length"), "base")
        steps, _, more = written(moved.unionByName(kept), f"order-steps{rounds}")
        last, rounds = finished, rounds + 1
    return levels


def runnable(order: DataFrame, applicable: DataFrame) -> DataFrame:
    """The part of an order whose nodes are applicable, in that order."""
    return order.join(applicable.select("id").distinct(), "id", "left_semi").orderBy("level", "seq", "id")


def _pauses(outcomes: DataFrame) -> DataFrame:
    """First pausing event of each node: input required with a context id."""
    asks = (F.col("state") == "input_required") & F.coalesce(F.col("context_id") != "", F.lit(False))
    return (
        outcomes.filter(asks)
        .groupBy(F.col("node_id").alias("id"))
        .agg(F.min("seq").alias("pause_seq"))
    )


def run_states(order: DataFrame, outcomes: DataFrame, workflow: str = "workflow_id") -> DataFrame:
    """Final node states of a run: ``workflow, id, level, seq, node_state, workflow_state``.

    ``order`` holds ``workflow, id, level, seq``; ``outcomes`` hold ``node_id,
    seq, state, context_id``. Nodes before the first pausing one are COMPLETED,
    that one is PAUSED, later ones stay READY. The first pause is a minimum per
    workflow, so no ordered scan is needed.
    """
    paused = order.join(_pauses(outcomes), "id", "left")
    place = F.struct("level", "seq", "id")
    stops = paused.groupBy(workflow).agg(
        F.min(F.when(F.col("pause_seq").isNotNull(), place)).alias("_stop")
    )
    state = (
        F.when(F.col("_stop").isNull() | (place < F.col("_stop")), F.lit("COMPLETED"))
        .when(place == F.col("_stop"), F.lit("PAUSED"))
        .otherwise(F.lit("READY"))
    )
    whole = F.when(F.col("_stop").isNull(), F.lit("COMPLETED")).otherwise(F.lit("PAUSED"))
    return skew_join(paused, stops, [workflow]).select(
        workflow,
        "id",
        "level",
        "seq",
        state.alias("node_state"),
        whole.alias("workflow_state"),
    )


def emitted_events(states: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Events a run emits: all of completed nodes, those of the paused node up
    to and including the pausing one, none of nodes that never ran."""
    ran = states.filter(F.col("node_state") != "READY").select("id", "node_state")
    limits = ran.join(_pauses(outcomes), "id", "left").withColumnRenamed("id", "node_id")
    return (
        skew_join(outcomes, limits.filter(F.col("node_id").isNotNull()), ["node_id"])
        .filter((F.col("node_state") == "COMPLETED") | (F.col("seq") <= F.col("pause_seq")))
        .select(*outcomes.columns)
    )
