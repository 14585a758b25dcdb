"""Stored search index: postings in blocks with bounds, top k that skips blocks.

Documents are indexed where they are read, in shards of a bounded number of
words, without a shuffle. A shard holds its documents by key, and for every word
a posting list. Documents of a shard are cut into blocks of equal size; a list
also keeps, for each block it touches, its greatest frequency and least document
length. They bound a block's BM25 score whatever the corpus counts become, so
segments can be added and old ones stay as they are.

A search reads the lists of the words asked for, never a text. Blocks of a shard
are visited by falling bound until no bound reaches the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.functions.vectors import tokens
from agentlake.operators.vectors import rank
from agentlake.session import written

K1 = 1.2
B = 0.75
DECIMALS = 6
#: Words of a shard, documents of a block, (query, word) pairs searched together,
#: and blocks visited at first.
SHARD_WORDS = 2_000_000
BLOCK_DOCS = 64
BLOCK_PAIRS = 200_000
FIRST_BLOCKS = 8
#: Posting lists that leave a task at a time.
LISTS_AT_ONCE = 8_192

_LISTS = ("docs", "counts", "blocks", "starts", "most", "least")
_DOCS, _POSTINGS, _QUERIES = 0, 1, 2


def _shard(shard: int, keys: pa.Array, lengths: np.ndarray, words: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of one shard: its documents, then a posting list per word."""
    order = pc.sort_indices(keys).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    by_place = lengths[order]

    def rows(n: int, columns: dict) -> pa.RecordBatch:
        whole = {"shard": pa.array(np.full(n, shard)), **columns}
        return pa.RecordBatch.from_arrays([whole.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)

    one = pa.array([0, len(order)], pa.int32())
    yield rows(
        1,
        {
            "kind": pa.array([_DOCS]), "n": pa.array([len(order)]), "words": pa.array([int(lengths.sum())]),
            "keys": pa.ListArray.from_arrays(one, keys.take(pa.array(order))), "lengths": pa.ListArray.from_arrays(one, pa.array(by_place, pa.int32())),
        },
    )
    if not len(words):
        return
    coded = words.dictionary_encode()
    tokens_of, pair = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    del words, coded
    # In place, as each of these is as long as the shard has words.
    pair *= len(order)
    pair += np.repeat(place, lengths)
    pair.sort()
    begin = np.flatnonzero(np.diff(pair, prepend=-1))
    counts = np.diff(begin, append=len(pair)).astype(np.int32)
    pair = pair[begin]
    del begin
    word, doc = (pair // len(order)).astype(np.int32), (pair % len(order)).astype(np.int32)
    del pair
    first = np.flatnonzero(np.diff(word, prepend=-1))
    # A touched block begins where the word or the block changes.
    block = doc // BLOCK_DOCS
    touched = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    lists = {
        "docs": doc, "counts": counts, "blocks": block[touched], "starts": touched - np.repeat(first, np.diff(np.append(np.searchsorted(touched, first), len(touched)))),
        "most": np.maximum.reduceat(counts, touched), "least": np.minimum.reduceat(by_place[doc], touched),
    }
    ends = {name: np.append(first if name in ("docs", "counts") else np.searchsorted(touched, first), len(lists[name])) for name in lists}
    size = np.diff(ends["docs"])
    for low in range(0, len(first), LISTS_AT_ONCE):
        high = min(low + LISTS_AT_ONCE, len(first))
        columns = {}
        for name, values in lists.items():
            cuts = ends[name][low : high + 1]
            columns[name] = pa.ListArray.from_arrays(pa.array(cuts - cuts[0], pa.int32()), pa.array(values[cuts[0] : cuts[-1]], pa.int32()))
        token = tokens_of.take(pa.array(word[first[low:high]]))
        yield rows(high - low, {"kind": pa.array(np.full(high - low, _POSTINGS)), "token": token, "n": pa.array(size[low:high]), **columns})


def add_documents(
    docs: DataFrame, path: str, segment: int, doc_key: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS
) -> None:
    """Index ``docs`` as one segment of the index at ``path``.

    A segment's number names its folder, so a repeated call replaces it. Keys are
    unique over all segments; rows without a key are left out, and a NULL text
    has no words.
    """
    rows = docs.filter(F.col(doc_key).isNotNull()).select(
        F.col(doc_key).alias("key"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("words")
    )
    whole = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("token", T.StringType()),
            T.StructField("n", T.LongType()), T.StructField("words", T.LongType()),
            T.StructField("keys", T.ArrayType(rows.schema["key"].dataType)), T.StructField("lengths", whole),
            *[T.StructField(name, whole) for name in _LISTS],
        ]
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        kinds = None

        def flushed() -> Iterator[pa.RecordBatch]:
            # ``held`` is emptied, so texts do not stay beside the lists made of them.
            keys = pa.concat_arrays([b.column("key") for b in held])
            lengths = np.concatenate([pc.list_value_length(b.column("words")).to_numpy(zero_copy_only=False) for b in held])
            parts = [b.column("words").flatten() for b in held]
            held.clear()
            yield from _shard(number, keys, lengths.astype(np.int64), pa.concat_arrays(parts), kinds)
            pa.default_memory_pool().release_unused()

        for batch in batches:
            if kinds is None:
                integers = pa.list_(pa.int32())
                kinds = pa.schema(
                    [("shard", pa.int64()), ("kind", pa.int32()), ("token", pa.string()), ("n", pa.int64()), ("words", pa.int64()),
                     ("keys", pa.list_(batch.schema.field("key").type)), ("lengths", integers), *[(name, integers) for name in _LISTS]]
                )
            sizes = pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False).astype(np.int64)
            begin = 0
            while begin < len(sizes):
                # A batch holds thousands of documents; a shard exceeds its words by one document at most.
                fit = int(np.searchsorted(np.cumsum(sizes[begin:]) + size, shard_words)) + 1
                held.append(batch.slice(begin, fit))
                size, begin = size + int(sizes[begin : begin + fit].sum()), begin + fit
                if size >= shard_words:
                    yield from flushed()
                    number, size = number + 1, 0
        if held:
            yield from flushed()

    rows.mapInArrow(shards, schema).write.mode("overwrite").parquet(f"{path}/segment={segment}")


class Shard:
    """Documents and asked posting lists of one shard in a task."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray, mean_len: float):
        self.keys = keys
        self.norm = K1 * (1 - B + B * lengths / mean_len)
        self.n_blocks = -(-len(lengths) // BLOCK_DOCS)
        self.mean_len, self.lists, self.visited, self.seen = mean_len, {}, 0, 0

    def add(self, row: dict) -> None:
        own = {name: np.asarray(row[name], np.int32) for name in _LISTS}
        own["ends"] = np.append(own["starts"][1:], len(own["docs"]))
        own["bound"] = own["most"] * (K1 + 1) / (own["most"] + K1 * (1 - B + B * own["least"] / self.mean_len))
        self.lists[row["token"]] = own

    def best(self, words: Sequence[str], idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the best ``k``, best first, ties by key."""
        asked = [(self.lists[w], weight) for w, weight in zip(words, idf) if w in self.lists]
        bound = np.zeros(self.n_blocks)
        for own, weight in asked:
            bound[own["blocks"]] += weight * own["bound"]
        order = np.argsort(-bound, kind="stable")[: int((bound > 0).sum())]
        self.seen += len(order)
        at, step, least = 0, FIRST_BLOCKS, -1.0
        docs, scores = np.empty(0, np.int64), np.empty(0)
        slot = np.full(self.n_blocks, -1)
        while at < len(order):
            # Scores are rounded, so a bound may lie a last digit below the k-th.
            now = order[at : at + step]
            now = now[bound[now] >= least - 10.0**-DECIMALS]
            if not len(now):
                break
            self.visited += len(now)
            slot[now] = np.arange(len(now))
            cells = np.zeros(len(now) * BLOCK_DOCS)
            for own, weight in asked:
                hit = np.flatnonzero(slot[own["blocks"]] >= 0)
                size = own["ends"][hit] - own["starts"][hit]
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(own["starts"][hit], size)
                doc, count = own["docs"][place], own["counts"][place]
                cells[slot[doc // BLOCK_DOCS] * BLOCK_DOCS + doc % BLOCK_DOCS] += weight * (count * (K1 + 1) / (count + self.norm[doc]))
            slot[now] = -1
            found = np.flatnonzero(cells > 0)
            docs = np.concatenate([docs, now[found // BLOCK_DOCS] * BLOCK_DOCS + found % BLOCK_DOCS])
            scores = np.concatenate([scores, np.round(cells[found], DECIMALS)])
            kept = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[kept], scores[kept]
            least = scores[-1] if len(scores) == k else -1.0
            at, step = at + step, 2 * step
        return docs, scores


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 10, doc_key: str = "doc_id", query_key: str = "query_id", text: str = "text"
) -> DataFrame:
    """Best ``k`` documents per query: ``query_key, rank, doc_key, score``.

    BM25 over the counts of all segments at ``path``, with the rows of an exact
    scan: scores rounded to six decimals, ties by the smaller key. Queries
    without a key are not asked. A shard and a block of queries meet in a task.
    """
    index = spark.read.parquet(path)
    heads, lists = index.filter(F.col("kind") == _DOCS), index.filter(F.col("kind") == _POSTINGS)
    asked, _, some = written(
        queries.filter(F.col(query_key).isNotNull()).select(
            F.col(query_key).alias("query"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("token")
        ),
        "asked-words",
    )
    schema = T.StructType(
        [
            T.StructField("query", asked.schema["query"].dataType),
            T.StructField("doc", index.schema["keys"].dataType.elementType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    total = heads.agg(F.sum("n").alias("docs"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("shards")).first()
    if not some or not total["words"]:
        return rank(spark.createDataFrame([], schema), ["query"], "score", "doc", k).select(
            F.col("query").alias(query_key), "rank", F.col("doc").alias(doc_key), "score"
        )
    mean_len = total["words"] / total["docs"]
    met, _, _ = written(lists.join(asked.select("token").distinct(), "token", "left_semi").drop("keys", "lengths", "words"), "asked-lists")
    counted = met.groupBy("token").agg(F.sum("n").alias("df"))
    idf = F.log1p((F.lit(float(total["docs"])) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")
    blocks = max(1, ceil(asked.count() / BLOCK_PAIRS))
    packs = (
        asked.join(counted, "token")
        .select("query", "token", idf, F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("pack"))
        .groupBy("pack")
        .agg(*[F.collect_list(c).alias(f"asked_{c}") for c in ("query", "token", "idf")])
    )
    every = heads.select("segment", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("pack"))
    asking = every.join(packs, "pack").withColumn("kind", F.lit(_QUERIES))
    both = (
        heads.select("segment", "shard", "kind", "keys", "lengths")
        .unionByName(met.drop("n"), allowMissingColumns=True)
        .unionByName(asking, allowMissingColumns=True)
    )
    dealt = both.repartition(max(1, min(int(total["shards"]), 20_000)), "segment", "shard").sortWithinPartitions("segment", "shard", "kind")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard: Shard | None = None
        for batch in batches:
            for row in batch.to_dict("records"):
                if row["kind"] == _DOCS:
                    shard = Shard(np.asarray(row["keys"]), np.asarray(row["lengths"], np.int64), mean_len)
                elif row["kind"] == _POSTINGS:
                    shard.add(row)
                else:
                    yield _answers(shard, row, k)

    best = rank(dealt.mapInPandas(found, schema), ["query"], "score", "doc", k)
    return best.select(F.col("query").alias(query_key), "rank", F.col("doc").alias(doc_key), "score")


def _answers(shard: Shard, row: dict, k: int) -> pd.DataFrame:
    """The best documents of a shard for a block of queries."""
    query, number = np.unique(np.asarray(row["asked_query"]), return_inverse=True)
    by = np.argsort(number, kind="stable")
    words, idf = np.asarray(row["asked_token"], object)[by], np.asarray(row["asked_idf"], float)[by]
    cuts = np.searchsorted(number[by], np.arange(len(query) + 1))
    parts = [shard.best(words[a:b], idf[a:b], k) for a, b in zip(cuts[:-1], cuts[1:])]
    return pd.DataFrame(
        {
            "query": np.repeat(query, [len(d) for d, _ in parts]),
            "doc": np.concatenate([shard.keys[d] for d, _ in parts]),
            "score": np.concatenate([s for _, s in parts]),
        }
    )
