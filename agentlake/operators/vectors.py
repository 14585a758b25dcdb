"""Embedding text and exact top matches by dot product."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.functions.vectors import token_bucket, tokens
from agentlake.session import written

_LOG = logging.getLogger(__name__)

DIM = 256
#: Largest item matrix sent to every worker.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows of one group of items, and queries scored at a time.
BLOCK_ROWS = 16_384
CHUNK_ROWS = 1_024
#: Items scored at a time, pairs for each that is scored a second time at most, and
#: the largest number that single precision takes part with.
CHUNK_ITEMS = 2_048
DENSE = 64
LARGEST = 1e15
#: Centres at most, which every task holds, centres for as many items as a group
#: takes, and queries of a task that meet a group, on average.
MOST_GROUPS = 16_384
CENTRES = 4
SLICE_QUERIES = 65_536
#: Queries and items of a task where queries meet all groups that may hold a best item.
MEETING_QUERIES = 32_768
MEETING_ITEMS = 262_144
DECIMALS = 6


def embed(
    df: DataFrame,
    text: str,
    out: str = "embedding",
    fn: Callable[[pd.Series], pd.Series] | None = None,
    dim: int = DIM,
) -> DataFrame:
    """Add a vector per row.

    ``fn`` maps a batch of texts to a batch of float arrays (a local model, for
    example). The default counts tokens in MD5 buckets and scales to length 1;
    tokens and buckets are computed in the JVM, only small whole numbers reach
    Python.
    """
    if fn is not None:
        apply = F.pandas_udf(fn, T.ArrayType(T.FloatType()))
        return df.withColumn(out, apply(F.col(text)))

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def scaled_counts(buckets: pd.Series) -> pd.Series:
        sizes = buckets.map(len).to_numpy()
        rows = np.repeat(np.arange(len(buckets)), sizes)
        flat = np.concatenate(buckets.to_list()) if sizes.sum() else np.empty(0, dtype=np.int64)
        counts = np.zeros((len(buckets), dim))
        np.add.at(counts, (rows, flat.astype(np.int64)), 1.0)
        length = np.linalg.norm(counts, axis=1, keepdims=True)
        scaled = np.divide(counts, length, out=np.zeros_like(counts), where=length > 0)
        return pd.Series(list(scaled.astype(np.float32)))

    words = tokens(F.coalesce(F.col(text), F.lit("")))
    return df.withColumn(out, scaled_counts(F.transform(words, lambda t: token_bucket(t, dim))))


def rank(scores: DataFrame, by: Sequence[str], score: str, key: str, k: int = 1) -> DataFrame:
    """Top ``k`` rows per group by falling score, ties by ``key``; adds ``rank``.

    Spark limits each group before the shuffle, so a hot group moves ``k`` rows
    per task.
    """
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(key))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _matrix(column: pd.Series, kind: type = np.float64) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(kind) if len(column) else np.empty((0, 0))


def _listed(keys: np.ndarray, whole: bool) -> list:
    """Keys as a list; pandas gives whole numbers beside a missing one as float."""
    return [None if key != key else int(key) if whole else key for key in keys.tolist()]


def _best(
    query_keys: np.ndarray,
    queries: np.ndarray,
    item_keys: np.ndarray,
    items: np.ndarray,
    k: int,
    exclude_self: bool,
) -> pd.DataFrame:
    """Exact top ``k`` items of every query; items come sorted by key."""
    row, place, score = _nearest(query_keys, queries, item_keys, items, k, exclude_self)
    return pd.DataFrame({"query": query_keys[row], "item": item_keys[place], "score": score})


def _nearest(
    query_keys: np.ndarray,
    queries: np.ndarray,
    item_keys: np.ndarray,
    items: np.ndarray,
    k: int,
    exclude_self: bool,
    least: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and items, and scores, of the exact top ``k`` of every query.

    A product in single precision is off by a bounded error. It tells which pairs
    can still be among the best, and only those are scored in double precision.
    Items below ``least`` of a query are left out.
    """
    # What holds no number never wins, whatever k.
    asking, usable = (np.flatnonzero(np.isfinite(m).all(axis=1)) for m in (queries, items))
    if len(asking) < len(queries):
        query_keys, queries, least = query_keys[asking], queries[asking], None if least is None else least[asking]
    if len(usable) < len(items):
        item_keys, items = item_keys[usable], items[usable]
    keep = min(k, len(item_keys))
    if not keep or not len(query_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    same = _same(query_keys, item_keys) if exclude_self else (np.empty(0, np.int64), np.empty(0, np.int64))
    longest = np.sqrt(np.einsum("ij,ij->i", items, items, dtype=float).max())
    small = max(np.abs(items).max(initial=0), np.abs(queries).max(initial=0)) <= LARGEST
    if small:
        asked32, items32 = queries.astype(np.float32), items.astype(np.float32, copy=False)
    found = []
    for start in range(0, len(query_keys), CHUNK_ROWS):
        asked = queries[start : start + CHUNK_ROWS].astype(float)
        score, place = np.full((len(asked), keep), -np.inf), np.full((len(asked), keep), -1)
        limit = score[:, -1] if least is None else least[start : start + CHUNK_ROWS]
        error = (asked.shape[1] + 8) * 2.0**-24 * np.sqrt((asked * asked).sum(axis=1)) * longest + 10.0**-DECIMALS
        low, high = np.searchsorted(same[0], (start, start + len(asked)))
        order = np.argsort(same[1][low:high], kind="stable")
        own_row, own_place = same[0][low:high][order] - start, same[1][low:high][order]
        for first in range(0, len(item_keys), CHUNK_ITEMS):
            part = items[first : first + CHUNK_ITEMS]
            own = slice(*np.searchsorted(own_place, (first, first + len(part))))
            worst, sparse = np.maximum(score[:, -1], limit), False
            if small and np.isfinite(worst).all():
                rough = asked32[start : start + CHUNK_ROWS] @ items32[first : first + CHUNK_ITEMS].T
                rough[own_row[own], own_place[own] - first] = -np.inf
                row, column = np.divmod(np.flatnonzero(rough >= (worst - error).astype(np.float32)[:, None]), len(part))
                sparse = len(row) * DENSE <= rough.size
            if sparse:
                exact = np.round(np.einsum("ij,ij->i", asked[row], part[column], dtype=float), DECIMALS) + 0.0
            else:
                every = np.round(asked @ part.T.astype(float), DECIMALS) + 0.0
                every[~np.isfinite(every)] = -np.inf
                every[own_row[own], own_place[own] - first] = -np.inf
                nth = len(part) - min(keep, len(part))
                edge = np.maximum(np.partition(every, nth, axis=1)[:, nth], worst)
                row, column = np.nonzero((every >= edge[:, None]) & (every > -np.inf))
                exact = every[row, column]
            # An item met later has the greater key, so it loses a tie.
            better = (exact > score[row, -1]) & (exact >= limit[row])
            _merge(score, place, row[better], column[better] + first, exact[better])
        row, nth = np.nonzero(place >= 0)
        found.append((row + start, place[row, nth], score[row, nth]))
    row, place, score = (np.concatenate(x) for x in zip(*found))
    return asking[row], usable[place], score


def _same(query_keys: np.ndarray, item_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and items with one key, by query. A missing number equals none."""
    real = np.flatnonzero(query_keys == query_keys)
    place, _ = pd.Index(item_keys).get_indexer_non_unique(pd.Index(query_keys[real]))
    times = pd.Series(item_keys).value_counts(dropna=False).reindex(query_keys[real]).fillna(1).to_numpy(np.int64)
    row = np.repeat(real, times)
    return row[place >= 0], place[place >= 0]


def _merge(score: np.ndarray, place: np.ndarray, row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
    """Puts values into the best of their rows, which stay sorted; ties by place in order of arrival."""
    if not len(row):
        return
    keep = score.shape[1]
    order = np.lexsort((at, -value, row))
    changed, begin, slot = np.unique(row[order], return_index=True, return_inverse=True)
    nth = np.arange(len(row)) - begin[slot]
    order, slot, nth = order[nth < keep], slot[nth < keep], nth[nth < keep]
    scores, places = np.full((len(changed), 2 * keep), -np.inf), np.full((len(changed), 2 * keep), -1)
    scores[:, :keep], places[:, :keep] = score[changed], place[changed]
    scores[slot, keep + nth], places[slot, keep + nth] = value[order], at[order]
    best = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
    score[changed], place[changed] = np.take_along_axis(scores, best, axis=1), np.take_along_axis(places, best, axis=1)


def top_match(
    queries: DataFrame,
    items: DataFrame,
    query_key: str,
    item_key: str,
    query_vector: str = "embedding",
    item_vector: str = "embedding",
    k: int = 1,
    exclude_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Items with the highest dot product per query: ``query_key, item, score, rank``.

    Keys are unique in each table; rows without a vector take no part.

    Scores are rounded to six decimals before they are compared; ties go to the
    smaller item key. The item side is measured first. Up to
    ``broadcast_bytes`` it is sent to the workers once and the queries are
    scored where they are, or dealt evenly if the items are many. Beyond that items form groups of
    about ``block_rows``, and a query meets only groups that may hold one of its
    best. Only ``k`` rows per query and group leave a task.
    """
    asked = queries.select(F.col(query_key).alias("query"), F.col(query_vector).alias("qv"))
    offered = items.select(F.col(item_key).alias("item"), F.col(item_vector).alias("iv")).filter(
        F.col("iv").isNotNull()
    )
    asked = asked.filter(F.col("qv").isNotNull())
    schema = T.StructType(
        [
            T.StructField("query", asked.schema["query"].dataType),
            T.StructField("item", offered.schema["item"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    measured = offered.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.size("iv").cast("long")), F.lit(0)).alias("numbers"),
        F.coalesce(F.sum(F.length(F.col("item").cast("string")).cast("long")), F.lit(0)).alias("letters"),
    ).first()
    if measured["numbers"] * 8 + measured["letters"] + measured["rows"] * 64 <= broadcast_bytes:
        if measured["rows"] >= BLOCK_ROWS:
            # A row's scores then cost far more than its way, and few files would leave cores idle.
            asked = asked.repartition(4 * asked.sparkSession.sparkContext.defaultParallelism)
        scores = _by_broadcast(asked, offered, schema, k, exclude_self)
        ranked = rank(scores, ["query"], "score", "item", k) if k > 1 else scores.withColumn("rank", F.lit(1))
    else:
        scores = _by_groups(asked, offered, schema, k, exclude_self, measured["rows"], block_rows)
        ranked = rank(scores, ["query"], "score", "item", k)
    return ranked.select(F.col("query").alias(query_key), "item", "score", "rank")


def _by_broadcast(
    asked: DataFrame, offered: DataFrame, schema: T.StructType, k: int, exclude_self: bool
) -> DataFrame:
    # Within the measured bound, so the table fits the driver and every worker.
    local = offered.toPandas().sort_values("item", ignore_index=True)
    shared = asked.sparkSession.sparkContext.broadcast((local["item"].to_numpy(), _matrix(local["iv"])))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        item_keys, matrix = shared.value
        for batch in batches:
            if len(batch) and len(item_keys):
                yield _best(
                    batch["query"].to_numpy(), _matrix(batch["qv"]), item_keys, matrix, k, exclude_self
                )

    return asked.mapInPandas(score, schema)


def _by_groups(
    asked: DataFrame,
    offered: DataFrame,
    schema: T.StructType,
    k: int,
    exclude_self: bool,
    item_rows: int,
    block_rows: int,
) -> DataFrame:
    """Every query's best items, leaving out groups that cannot hold one.

    Items gather around centres, some of the items themselves; what gathers
    around one is cut into groups of about ``block_rows``. No item x of a group
    with mean c and radius r has a product above q.c + |q| r. Each query first
    meets the group with the greatest such bound, and then those whose bound
    reaches the k-th score found so far. For that, queries travel in blocks with
    those of the same likeliest group, and a task takes some thousands of them and
    a bounded part of the groups, so what is shuffled is the number of such
    meetings, not a row for each query and group.
    """
    spark = asked.sparkSession
    block_rows = max(block_rows, ceil(item_rows / MOST_GROUPS))
    finite = F.forall("iv", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = offered.filter(finite)
    # At most MOST_GROUPS vectors, whatever the table.
    centres = [r["iv"] for r in usable.orderBy(F.xxhash64("item")).limit(min(MOST_GROUPS, ceil(CENTRES * item_rows / block_rows))).select("iv").collect()]
    if not centres:
        return spark.createDataFrame([], schema)
    around = spark.sparkContext.broadcast(np.array(centres, float))
    placed = T.StructType([T.StructField("group", T.LongType()), *usable.schema.fields])

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre = around.value
        square = (centre * centre).sum(axis=1)
        for batch in batches:
            for start in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[start : start + CHUNK_ROWS]
                nearest = (square - 2 * _matrix(part["iv"]) @ centre.T).argmin(axis=1)
                yield part.assign(group=nearest)[placed.names]

    rows, _, _ = written(usable.mapInPandas(gathered, placed), "gathered")
    parts, _, _ = written(
        rows.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("parts")), "group-parts"
    )
    cell = (F.col("group") * (1 << 32) + F.pmod(F.xxhash64("item"), F.col("parts"))).alias("cell")
    cut = rows.join(parts, "group").select(cell, "item", "iv").repartition("cell").sortWithinPartitions("cell", "item")
    blob = T.StructType(
        [
            T.StructField("cell", T.LongType()), T.StructField("items", T.ArrayType(schema["item"].dataType)),
            T.StructField("matrix", T.BinaryType()), T.StructField("centre", T.BinaryType()), T.StructField("radius", T.DoubleType()),
        ]
    )

    # Numbers of single precision stay so, which halves what is dealt.
    kind = np.float32 if usable.schema["iv"].dataType.elementType == T.FloatType() else np.float64
    whole = isinstance(schema["item"].dataType, T.IntegralType)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _runs(batches, "cell"):
            matrix = _matrix(part["iv"], kind)
            centre = matrix.mean(axis=0, dtype=float)
            radius = float(np.sqrt(((matrix - centre) ** 2).sum(axis=1).max()))
            row = (int(part["cell"].iloc[0]), _listed(part["item"].to_numpy(), whole), matrix.tobytes(), centre.tobytes(), radius)
            yield pd.DataFrame([row], columns=blob.names)

    groups, _, _ = written(cut.mapInPandas(packed, blob), "vector-groups")
    summary = groups.select("cell", "centre", "radius").orderBy("cell").collect()
    shared = spark.sparkContext.broadcast(
        (
            np.array([r["cell"] for r in summary]),
            np.stack([np.frombuffer(r["centre"]) for r in summary]),
            np.array([r["radius"] for r in summary]),
        )
    )
    visit = T.StructType([T.StructField("cell", T.LongType()), *asked.schema.fields])

    def bounds(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """What no item of a group exceeds, and the likeliest group."""
        _, centre, radius = shared.value
        matrix = _matrix(vectors)
        length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        with np.errstate(invalid="ignore", over="ignore"):
            bound = matrix @ centre.T + length * radius
        bound[~np.isfinite(bound)] = np.inf
        # The bound itself is off by a few last digits.
        return bound + 1e-9 * np.abs(bound), bound.argmax(axis=1)

    def likeliest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[start : start + CHUNK_ROWS]
                yield part.assign(cell=shared.value[0][bounds(part["qv"])[1]])[visit.names]

    def met(visiting: DataFrame) -> DataFrame:
        slices = max(1, ceil(visiting.count() / len(summary) / SLICE_QUERIES))
        every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
        left = groups.select("cell", "items", "matrix", every, F.lit(0).alias("kind"))
        # Queries travel in the column of the items; with NULLs beside them, pandas would round whole numbers.
        own = F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int").alias("slice")
        right = visiting.select("cell", F.array("query").alias("items"), "qv", own, F.lit(1).alias("kind"))
        both = left.unionByName(right, allowMissingColumns=True)
        dealt = both.repartition("cell", "slice").sortWithinPartitions("cell", "slice", "kind")

        def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            keys, matrix = np.empty(0), np.empty((0, 0))
            for batch in batches:
                for (_, _, role), part in batch.groupby(["cell", "slice", "kind"], sort=True):
                    if role == 0:
                        keys = np.asarray(part["items"].iloc[0])
                        matrix = np.frombuffer(part["matrix"].iloc[0], kind).reshape(len(keys), -1)
                    else:
                        yield _best(np.concatenate(part["items"].to_list()), _matrix(part["qv"]), keys, matrix, k, exclude_self)

        return dealt.mapInPandas(scored, schema)

    first, _, _ = written(asked.mapInPandas(likeliest, visit), "visits")
    near, _, _ = written(rank(met(first), ["query"], "score", "item", k), "nearest-group")
    full = near.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)

    # Queries of neighbouring groups share a slice; one that many find likeliest has several.
    counts = {r["cell"]: r["n"] for r in first.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    begins, several, used, filled = [], [], 0, 0
    for r in summary:
        n = counts.get(r["cell"], 0)
        if filled and filled + n > MEETING_QUERIES:
            used, filled = used + 1, 0
        begins.append(used)
        several.append(ceil(n / MEETING_QUERIES) or 1)
        used, filled = (used + several[-1], 0) if several[-1] > 1 else (used, filled + n)
    slices, parts = used + 1, ceil(item_rows / MEETING_ITEMS) or 1
    slicing = spark.sparkContext.broadcast((np.array(begins), np.array(several)))
    block = T.StructType(
        [
            T.StructField("slice", T.LongType()), T.StructField("items", T.ArrayType(schema["query"].dataType)), T.StructField("matrix", T.BinaryType()),
            T.StructField("least", T.BinaryType()), T.StructField("own", T.BinaryType()),
            T.StructField("open", T.ArrayType(T.LongType())), T.StructField("visits", T.LongType()),
        ]
    )
    whole_query = isinstance(schema["query"].dataType, T.IntegralType)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries that have further groups to meet, packed by slice."""
        begin, number = slicing.value
        for batch in batches:
            held = []
            for start in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[start : start + CHUNK_ROWS]
                bound, own = bounds(part["qv"])
                # Scores are rounded.
                least = part["least"].fillna(-np.inf).to_numpy(float) - 10.0**-DECIMALS
                opened = bound >= least[:, None]
                opened[np.arange(len(part)), own] = False
                own_slice = begin[own] + np.arange(start, start + len(part)) % number[own]
                for value in np.unique(own_slice[opened.any(axis=1)]):
                    at = np.flatnonzero((own_slice == value) & opened.any(axis=1))
                    held.append((value, part.iloc[at], least[at], own[at], opened[at].any(axis=0), int(opened[at].sum())))
            rows = []
            for value in sorted({h[0] for h in held}):
                part, least, own, opened, visits = zip(*[h[1:] for h in held if h[0] == value])
                together = pd.concat(part)
                rows.append(
                    (
                        int(value), _listed(together["query"].to_numpy(), whole_query), _matrix(together["qv"]).tobytes(),
                        np.concatenate(least).tobytes(), np.concatenate(own).astype(np.int64).tobytes(),
                        np.flatnonzero(np.any(opened, axis=0)).tolist(), sum(visits),
                    )
                )
            yield pd.DataFrame(rows, columns=block.names)

    packs, _, some = written(asked.join(full.drop("n"), "query", "left").mapInPandas(blocks, block), "query-blocks")
    further = packs.agg(F.coalesce(F.sum("visits"), F.lit(0)).alias("n")).first()["n"]
    _LOG.info("%d further visits of %d groups", further, len(summary))
    best = near.select("query", "item", "score")
    if not some:
        return best
    places = spark.createDataFrame([(i, r["cell"]) for i, r in enumerate(summary)], "at long, cell long")
    task = (F.col("slice") * parts + F.pmod(F.col("at"), F.lit(parts))).alias("task")
    meetings, _, _ = written(packs.select("slice", F.explode("open").alias("at")).distinct().join(places, "at").select("slice", task, "at", "cell"), "meetings")
    asking = packs.drop("open", "visits").join(meetings.select("slice", "task").distinct(), "slice").drop("slice")
    offering = meetings.select("task", "at", "cell").join(groups, "cell").select("task", "at", F.col("items").alias("offered"), "matrix")
    both = asking.withColumn("at", F.lit(-1).cast("long")).unionByName(offering, allowMissingColumns=True)
    dealt = both.repartitionById(max(1, min(slices * parts, 20_000)), F.col("task").cast("int")).sortWithinPartitions("task", "at")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, held, asked_now = None, [], None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.task != task:
                    task, held, asked_now = row.task, [], None
                if row.at < 0:
                    held.append((np.asarray(row.items), np.frombuffer(row.matrix), np.frombuffer(row.least), np.frombuffer(row.own, np.int64)))
                    continue
                if asked_now is None:
                    keys, matrix, least, own = (np.concatenate(x) for x in zip(*held))
                    asked_now, held = matrix.reshape(len(keys), -1), []
                    length = np.sqrt((asked_now * asked_now).sum(axis=1))
                    known = np.repeat(least[:, None], k, axis=1)
                _, centre, radius = shared.value
                with np.errstate(invalid="ignore", over="ignore"):
                    bound = asked_now @ centre[row.at] + length * radius[row.at]
                bound[~np.isfinite(bound)] = np.inf
                now = np.flatnonzero((bound + 1e-9 * np.abs(bound) >= known[:, -1] - 10.0**-DECIMALS) & (own != row.at))
                offered = np.asarray(row.offered)
                items = np.frombuffer(row.matrix, kind).reshape(len(offered), -1)
                at, place, score = _nearest(keys[now], asked_now[now], offered, items, k, exclude_self, known[now, -1])
                _merge(known, np.zeros(known.shape, np.int64), now[at], place, score)
                yield pd.DataFrame({"query": keys[now[at]], "item": offered[place], "score": score})

    return best.unionByName(dealt.mapInPandas(meet, schema))


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames of equal ``key`` out of a stream sorted by it."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for value, part in batch.groupby(key, sort=True):
            if held and held[0][key].iloc[0] != value:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)
