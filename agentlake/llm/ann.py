"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

A shard's vectors enter its graph in batches. A greedy search for a new vector
proposes neighbours; relaxed pruning keeps a candidate only if no kept one is
``alpha`` times nearer to it than the new vector is, so edges point in diverse
directions. A beam search then answers the queries of a shard.

Largest inner product becomes nearest distance by one more coordinate, which
gives all vectors of a shard the same length; queries have 0 there. A shard holds
vectors of like length only, on a scale of its own, as a long one would leave
nothing but rounding of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.llm.text import packed, unpacked
from agentlake.session import written

#: Vectors of a shard, edges of a vector, beam widths and pruning's relaxation.
SHARD_ROWS = 16_384
DEGREE = 32
BUILD_BEAM, QUERY_BEAM = 64, 128
ALPHA = 1.2
#: Lengths of a shard differ by at most the square root of 2.
BAND = 0.5
#: A shard's own vectors that it is tried with, how many neighbours each, and the
#: share of them that its beam must find.
TRIED, TRIED_FOR, RECALL = 64, 20, 0.96
#: Queries that meet a shard in one task, and vectors handled together.
QUERY_BLOCK = 8_192
TOGETHER = 512
#: Tasks of a search at most; beyond, a task takes several pairs one by one.
MOST_TASKS = 20_000


def _distances(points: np.ndarray, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of ``points[rows]`` (b, k) to ``to`` (b, d)."""
    own = points[rows]
    dots = np.matmul(own, to[:, :, None])[:, :, 0]
    return np.einsum("bkd,bkd->bk", own, own) - 2 * dots + (to * to).sum(axis=1)[:, None]


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, to: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest ``beam`` points found for each row of ``to``: (rows, distances).

    All searches advance together: each expands the nearest points of its beam
    that it has not expanded yet, until no beam holds one. -1 pads.
    """
    b = len(to)
    found = np.full((b, beam), -1, np.int64)
    far = np.full((b, beam), np.inf, np.float32)
    done = np.ones((b, beam), bool)
    found[:, 0] = start
    far[:, 0] = _distances(points, np.full((b, 1), start), to)[:, 0]
    done[:, 0] = False
    active = np.arange(b)
    step = max(4, beam // 32)
    while len(active):
        open_far = np.where(done[active], np.inf, far[active])
        take = min(step, beam)
        pick = np.argpartition(open_far, take - 1, axis=1)[:, :take]
        valid = np.isfinite(np.take_along_axis(open_far, pick, axis=1))
        busy = valid.any(axis=1)
        active, pick, valid = active[busy], pick[busy], valid[busy]
        if not len(active):
            break
        own = found[active]
        chosen = np.where(valid, np.take_along_axis(own, pick, axis=1), -1)
        mark = done[active]
        np.put_along_axis(mark, pick, True, axis=1)
        done[active] = mark
        near = np.where(chosen[:, :, None] >= 0, edges[np.maximum(chosen, 0)], -1).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        distance = np.where(near >= 0, _distances(points, np.maximum(near, 0), to[active]), np.inf)
        # A point already in the beam must not come in again.
        ranked = np.sort(own, axis=1)
        at = (near + np.arange(len(active))[:, None] * (len(points) + 2)).ravel()
        flat = (ranked + np.arange(len(active))[:, None] * (len(points) + 2)).ravel()
        place = np.minimum(np.searchsorted(flat, at), len(flat) - 1)
        distance[(flat[place] == at).reshape(near.shape)] = np.inf
        all_rows = np.concatenate([own, near], axis=1)
        all_far = np.concatenate([far[active], distance.astype(np.float32)], axis=1)
        all_done = np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        far[active] = np.take_along_axis(all_far, best, axis=1)
        kept_far = far[active]
        found[active] = np.where(np.isfinite(kept_far), np.take_along_axis(all_rows, best, axis=1), -1)
        done[active] = np.take_along_axis(all_done, best, axis=1) | ~np.isfinite(kept_far)
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(far, order, axis=1)


def robust_prune(points: np.ndarray, rows: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Edges (n, degree) of ``rows`` out of ``candidates`` (n, k); -1 pads."""
    candidates = np.where(candidates == rows[:, None], -1, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    own = points[np.maximum(candidates, 0)]
    distance = np.where(candidates >= 0, _distances(points, np.maximum(candidates, 0), points[rows]), np.inf)
    norm = np.einsum("bkd,bkd->bk", own, own)
    edges = np.full((len(rows), degree), -1, np.int64)
    at = np.arange(len(rows))
    for k in range(degree):
        best = distance.argmin(axis=1)
        near = distance[at, best]
        alive = np.isfinite(near)
        if not alive.any():
            break
        edges[alive, k] = candidates[at, best][alive]
        star = own[at, best]
        between = norm + norm[at, best][:, None] - 2 * np.matmul(own, star[:, :, None])[:, :, 0]
        hidden = alpha * alpha * np.maximum(between, 0) <= distance
        hidden[at, best] = True
        distance[hidden & alive[:, None]] = np.inf
    return edges


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(edges, start) over all points; the start is the one nearest their mean.

    Points enter in a fixed random order in batches that double up to
    ``TOGETHER``; those of a batch are linked back at once.
    """
    n = len(points)
    edges = np.full((n, degree), -1, np.int64)
    if n == 0:
        return edges, 0
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        new = order[at : min(n, at + min(at, TOGETHER))]
        found, _ = beam_search(points, edges, start, points[new], beam)
        edges[new] = robust_prune(points, new, found, degree, alpha)
        source = np.repeat(new, degree)
        target = edges[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        slot = np.arange(len(target)) - np.repeat(first, count)
        back = np.full((len(heads), count.max()), -1, np.int64)
        back[np.repeat(np.arange(len(heads)), count), slot] = source
        for a in range(0, len(heads), TOGETHER):
            part = heads[a : a + TOGETHER]
            width = count[a : a + TOGETHER].max()
            both = np.concatenate([edges[part], back[a : a + TOGETHER, :width]], axis=1)
            full = (both >= 0).sum(axis=1) > degree
            tidy = -np.sort(-both, axis=1)[:, :degree]
            if full.any():
                tidy[full] = robust_prune(points, part[full], both[full], degree, alpha)
            edges[part] = tidy
        at += len(new)
    return edges, start


def _matrix(rows) -> np.ndarray:
    return np.stack([np.asarray(r, np.float64) for r in rows]) if len(rows) else np.empty((0, 0))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors over their lengths, however large or small they are."""
    own = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return own / np.sqrt((own * own).sum(axis=1, keepdims=True))


def lifted(vectors: np.ndarray) -> np.ndarray:
    """One more coordinate makes all lengths equal."""
    vectors = vectors / np.abs(vectors).max()
    square = (vectors * vectors).sum(axis=1)
    scale = 1.0 / np.sqrt(square.max())
    more = np.sqrt(np.maximum(square.max() - square, 0))
    return (np.column_stack([vectors, more]) * scale).astype(np.float32)


def _asked(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([_unit(vectors), np.zeros(len(vectors))]).astype(np.float32)


def _at_once(beam: int) -> int:
    """Searches that advance together; wide beams take fewer."""
    return max(8, TOGETHER * QUERY_BEAM // max(beam, QUERY_BEAM))


def tried_beam(vectors: np.ndarray, points: np.ndarray, edges: np.ndarray, start: int) -> int:
    """The least doubled beam that finds enough of the exact neighbours of some
    of the shard's own vectors; at most the whole shard."""
    n, beam = len(vectors), QUERY_BEAM
    if n <= beam:
        return n
    tried = np.random.default_rng(11).permutation(n)[:TRIED]
    own = vectors / np.abs(vectors).max()
    k = min(TRIED_FOR, n)
    score = own[tried] @ own.T
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    # What ties with the last neighbour is as good.
    least = np.take_along_axis(score, best, axis=1).min(axis=1)
    to = _asked(vectors[tried])
    while beam < n:
        hits = 0
        for a in range(0, len(tried), _at_once(beam)):
            part = slice(a, a + _at_once(beam))
            found, _ = beam_search(points, edges, start, to[part], beam)
            near = np.take_along_axis(score[part], np.maximum(found, 0), axis=1)
            hits += np.minimum(((near >= least[part, None]) & (found >= 0)).sum(axis=1), k).sum()
        if hits >= RECALL * k * len(tried):
            return beam
        beam *= 2
    return n


def usable(vector: Column) -> Column:
    """No NULL, NaN or infinite component, and not only zeros."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _band(vector: Column) -> Column:
    """Number of the vector's length on a logarithmic scale; length 1 is inside a band."""
    length = F.aggregate(vector, F.lit(0.0), F.hypot)
    return F.floor(F.log2(length) / BAND + 0.5).cast("int")


_INDEX = "number int, dim int, n int, beam int, keys binary, firsts binary, vectors binary, edges binary, start long"


def build_index(
    items: DataFrame, key: str, vector: str, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA
) -> DataFrame:
    """A row per shard: (number, dim, n, beam, keys, firsts, vectors, edges, start), written.

    Every usable row is in the graph of one shard, by a hash of its key and
    vector. Vectors with different numbers of components, or of lengths in
    different bands, are in different shards. ``beam`` is what the shard's own
    vectors need to find their neighbours. Equal vectors are one point of a
    graph, with all their keys: ``firsts`` are the starts of the points' keys, so
    copies neither crowd out edges nor hide one another.
    """
    spark = items.sparkSession
    rows = items.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector")
    ).withColumns({"dim": F.array_size("vector"), "band": _band(F.col("vector"))})
    sizes = rows.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("shards"))
    before = Window.orderBy("dim", "band").rowsBetween(Window.unboundedPreceding, -1)
    numbered, _, some = written(sizes.withColumn("first", F.coalesce(F.sum("shards").over(before), F.lit(0))), "graph-sizes")
    if not some:
        return spark.createDataFrame([], _INDEX)
    total = int(numbered.agg(F.sum("shards")).first()[0])
    own = F.col("first") + F.pmod(F.xxhash64("key", "vector"), F.col("shards"))
    sharded = rows.join(numbered, ["dim", "band"]).select(own.cast("int").alias("number"), "dim", "key", "vector")

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        vectors, point = np.unique(_matrix(frame["vector"].to_list()), axis=0, return_inverse=True)
        order = np.argsort(point.ravel(), kind="stable")
        firsts = np.searchsorted(point.ravel()[order], np.arange(len(vectors)))
        points = lifted(vectors)
        edges, start = build_graph(points, degree, beam, alpha)
        keys = packed(frame["key"].to_numpy(np.int64)[order])
        blobs = (keys, packed(firsts.astype(np.int32)), packed(vectors), packed(edges.astype(np.int32)))
        wide = tried_beam(vectors, points, edges, start)
        row = (int(frame["number"].iloc[0]), int(frame["dim"].iloc[0]), len(frame), wide, *blobs, start)
        return pd.DataFrame([row], columns=[c.split()[0] for c in _INDEX.split(", ")])

    def built(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _runs(batches, "number"):
            yield build(frame)

    dealt = sharded.repartitionById(total, F.col("number")).sortWithinPartitions("number", "key")
    return written(dealt.mapInPandas(built, _INDEX), "graph-shards")[0]


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


def search(
    index: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    k: int = 20,
    beam: int | None = None,
    exclude_self: bool = True,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Each query's ``k`` nearest found: (query_id, rank, vec_id, score).

    A query meets every shard of its number of components, in blocks of
    ``query_block``; a task holds one shard and one block. ``beam`` is that of
    the shard unless it is given. Scores are the inner products of the stored
    vectors in double precision, infinite where they leave its range; pairs
    whose product is not a number are left out. Ties go to the smaller key. A
    key met several times counts each time. Queries that are not usable, and
    keys that are NULL, give no rows.
    """
    spark = index.sparkSession
    asked = queries.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector")
    ).withColumn("dim", F.array_size("vector"))
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(query_block)).cast("int").alias("blocks")
    shards = index.groupBy("dim").agg(F.count(F.lit(1)).alias("shards"))
    sizes, _, some = written(asked.groupBy("dim").agg(blocks).join(shards, "dim"), "graph-queries")
    schema = "query_id long, rank int, vec_id long, score double"
    if not some:
        return spark.createDataFrame([], schema)
    tasks = int(min(sizes.agg(F.sum(F.col("blocks") * F.col("shards"))).first()[0], MOST_TASKS))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    # Shards carry a number for the query, as pandas would round ids beside NULLs.
    left = index.join(sizes, "dim").select(*index.columns, "blocks", each, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("query_id"))
    placed = asked.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.col("blocks")).cast("int"))
    right = placed.join(index.select("dim", "number"), "dim").select(
        "number", "dim", "blocks", "block", F.lit(1).alias("kind"), "query_id", "vector"
    )
    both = left.unionByName(right, allowMissingColumns=True)
    place = F.pmod(F.col("number").cast("long") * F.col("blocks") + F.col("block"), F.lit(tasks)).cast("int")
    dealt = both.repartitionById(tasks, place).sortWithinPartitions("number", "block", "kind")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, shard = None, None
        for batch in batches:
            for (number, block, kind), part in batch.groupby(["number", "block", "kind"], sort=True):
                if kind == 0:
                    now, shard = (number, block), _opened(part.iloc[0])
                elif now == (number, block):
                    yield from _nearest(shard, part["query_id"].to_numpy(np.int64), part["vector"].to_list(), k, beam, exclude_self)

    found = dealt.drop("blocks").mapInPandas(find, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _opened(row: pd.Series) -> dict:
    keys, firsts = unpacked(row["keys"], np.int64), unpacked(row["firsts"], np.int32).astype(np.int64)
    vectors = unpacked(row["vectors"], np.float64).reshape(len(firsts), int(row["dim"]))
    return {
        "keys": keys, "firsts": firsts, "vectors": vectors, "points": lifted(vectors), "start": int(row["start"]),
        "edges": unpacked(row["edges"], np.int32).astype(np.int64).reshape(len(firsts), -1), "beam": int(row["beam"]),
    }


def _nearest(shard: dict, ids: np.ndarray, asked: list, k: int, beam: int | None, exclude_self: bool) -> Iterator[pd.DataFrame]:
    """The best of a shard for some queries."""
    keys, firsts, vectors = shard["keys"], shard["firsts"], shard["vectors"]
    # A point's least keys that can be needed, should some be the query's own.
    needed = k + int(np.unique(keys, return_counts=True)[1].max())
    offered = np.minimum(np.diff(np.append(firsts, len(keys))), needed)
    wide = min(max(beam or shard["beam"], k + 1), len(firsts))
    for a in range(0, len(ids), _at_once(wide)):
        own, exact = ids[a : a + _at_once(wide)], _matrix(asked[a : a + _at_once(wide)])
        found, _ = beam_search(shard["points"], shard["edges"], shard["start"], _asked(exact), wide)
        with np.errstate(over="ignore", invalid="ignore"):
            score = np.matmul(vectors[np.maximum(found, 0)], exact[:, :, None])[:, :, 0]
        times = np.where(found >= 0, offered[np.maximum(found, 0)], 0).ravel()
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = keys[np.repeat(firsts[np.maximum(found, 0)].ravel(), times) + nth]
        hits = pd.DataFrame({"query_id": np.repeat(np.repeat(own, wide), times), "vec_id": other, "score": np.repeat(score.ravel(), times)})
        hits = hits[hits["score"].notna() & ~((hits["vec_id"] == hits["query_id"]) & exclude_self)]
        nearest_first = hits.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        yield nearest_first.groupby("query_id", sort=False).head(k)
