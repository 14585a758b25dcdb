"""Ranked text search: BM25 over tokens (Robertson and Zaragoza, 2009)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.functions.vectors import tokens
from agentlake.operators.searchindex import DECIMALS, K1, SHARD_WORDS, B, add_documents, search_index
from agentlake.operators.vectors import rank
from agentlake.session import scratch_path, written

#: Fixed value: most results one search returns.
RESULTS = 10
#: Most (query, token) pairs sent to every worker.
BROADCAST_PAIRS = 1_000_000
#: Queries scored at a time.
BLOCK_QUERIES = 1_000
#: Documents scored at a time, and numbers in one dense block.
CHUNK_ROWS = 512
BLOCK_CELLS = 4_000_000

_TOTAL = ""  # Stands for "any document" among the counted tokens.


def query_tokens(queries: DataFrame, key: str = "query_id", text: str = "text") -> DataFrame:
    """Distinct tokens of each query."""
    return queries.select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))


def corpus_counts(words: DataFrame, vocabulary: DataFrame, small: bool = False) -> DataFrame:
    """Documents per token of ``vocabulary``, and under ``""`` the number of
    documents with their summed length: ``token, df, length``.

    One pass over the texts. Counts are partial before the shuffle, so the most
    frequent token costs one row per task. A vocabulary known to be ``small``
    is broadcast to drop other tokens first.
    """
    total = vocabulary.sparkSession.createDataFrame([(_TOTAL,)], "token string")
    wanted = vocabulary.select("token").union(total).distinct()
    marked = F.array_append(F.array_distinct("words"), F.lit(_TOTAL))
    seen = words.select(F.size("words").alias("doc_len"), marked.alias("_seen")).select(
        "doc_len", F.explode("_seen").alias("token")
    )
    if small:
        seen = seen.join(F.broadcast(wanted), "token", "left_semi")
    counted = seen.groupBy("token").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.when(F.col("token") == _TOTAL, F.col("doc_len"))).alias("length")
    )
    return counted if small else counted.join(wanted, "token", "left_semi")


def _index(pairs: pd.DataFrame) -> dict[str, np.ndarray]:
    """Queries as a sparse token by query matrix of inverse document frequencies.

    A plain dict, so that it can be broadcast to workers without this package.
    """
    keys, columns = np.unique(pairs["query"].to_numpy(), return_inverse=True)
    vocabulary = pairs["token"].unique()
    rows = pd.Index(vocabulary).get_indexer(pairs["token"])
    weights = pairs["idf"].to_numpy(dtype=float)
    return {"keys": keys, "tokens": vocabulary, "rows": rows, "columns": columns, "weights": weights}


def _query_blocks(index: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query keys, dense weights) for a bounded number of queries at a time."""
    height = len(index["tokens"])
    width = max(1, min(len(index["keys"]), BLOCK_QUERIES, BLOCK_CELLS // max(1, height)))
    for start in range(0, len(index["keys"]), width):
        keys = index["keys"][start : start + width]
        inside = (index["columns"] >= start) & (index["columns"] < start + width)
        dense = np.zeros((height, len(keys)))
        dense[index["rows"][inside], index["columns"][inside] - start] = index["weights"][inside]
        yield keys, dense


def _shares(vocabulary: pd.Index, words: pd.Series, mean_len: float) -> np.ndarray:
    """Dense document by token matrix of length-adjusted term frequencies."""
    lengths = words.map(len).to_numpy()
    cells = np.zeros(0, dtype=np.int64)
    if lengths.sum():
        found = vocabulary.get_indexer(np.concatenate(words.to_list()))
        rows = np.repeat(np.arange(len(words)), lengths)
        cells = (rows * len(vocabulary) + found)[found >= 0]
    shape = (len(words), len(vocabulary))
    counts = np.bincount(cells, minlength=shape[0] * shape[1]).reshape(shape).astype(float)
    norm = K1 * (1 - B + B * lengths / mean_len)
    return counts * (K1 + 1) / (counts + norm[:, None])


def _keep(results: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = results.sort_values(["query", "score", "doc"], ascending=[True, False, True])
    return ordered.groupby("query", sort=False).head(k)


def _score(
    index: dict[str, np.ndarray], batches: Iterator[pd.DataFrame], mean_len: float, k: int
) -> pd.DataFrame:
    """Best ``k`` documents of the batches per query; never more than that is kept."""
    best = pd.DataFrame({"query": [], "doc": [], "score": []})
    vocabulary = pd.Index(index["tokens"])
    blocks = list(_query_blocks(index)) if len(index["tokens"]) * len(index["keys"]) <= BLOCK_CELLS else None
    rows = max(1, min(CHUNK_ROWS, BLOCK_CELLS // max(1, len(vocabulary))))
    for batch in batches:
        for start in range(0, len(batch), rows):
            chunk = batch.iloc[start : start + rows]
            shares = _shares(vocabulary, chunk["words"], mean_len)
            docs = chunk["doc"].to_numpy()
            by_key = np.argsort(docs, kind="stable")
            docs, shares = docs[by_key], shares[by_key]
            found = [best]
            for keys, weights in blocks or _query_blocks(index):
                # A match is a hit however little its words weigh.
                matched = shares @ weights
                scores = np.where(matched > 0, np.round(matched, DECIMALS), -1.0)
                keep = min(k, len(docs))
                chosen = np.argsort(-scores, axis=0, kind="stable")[:keep]
                values = np.take_along_axis(scores, chosen, axis=0)
                hits = values >= 0
                columns = np.broadcast_to(np.arange(len(keys)), chosen.shape)
                found.append(
                    pd.DataFrame(
                        {"query": keys[columns[hits]], "doc": docs[chosen[hits]], "score": values[hits]}
                    )
                )
            filled = [part for part in found if len(part)]
            if filled:
                best = _keep(pd.concat(filled), k)
    return best


def _idf(docs: float, df: pd.Series) -> pd.Series:
    return np.log1p((docs - df + 0.5) / (df + 0.5))


def _schema(words: DataFrame, asked: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query", asked.schema["query"].dataType),
            T.StructField("doc", words.schema["doc"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _by_broadcast(words: DataFrame, asked: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    # Both are within the measured bound: a row per query token, one per token.
    counted = counts.toPandas().set_index("token")
    docs, length = counted.loc[_TOTAL, ["df", "length"]] if _TOTAL in counted.index else (0, 0)
    pairs = asked.toPandas().join(counted["df"], on="token", how="inner")
    pairs["idf"] = _idf(docs, pairs["df"])
    mean_len = length / docs if docs else 0.0
    shared = words.sparkSession.sparkContext.broadcast(_index(pairs) if len(pairs) and mean_len else None)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if shared.value is not None:
            yield _score(shared.value, batches, mean_len, k)

    return words.mapInPandas(score, _schema(words, asked))


def text_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = RESULTS,
    doc_key: str = "doc_id",
    query_key: str = "query_id",
    fields: Sequence[str] = (),
    broadcast_pairs: int = BROADCAST_PAIRS,
    block_tokens: int = SHARD_WORDS,
) -> DataFrame:
    """Best ``k`` documents per query: ``query_key, rank, doc_key, score`` and ``fields``.

    Documents are scored where they are read: a task holds the queries' tokens
    and passes on ``k`` rows per query, so texts are not shuffled and a word
    common to many documents and queries never pairs them up as rows. Texts are
    split into tokens in the JVM. The query side is measured first; beyond
    ``broadcast_pairs`` query tokens the texts are indexed where they are read,
    and blocks of queries meet the index's shards. Rows without a key then take
    no part.

    Corpus counts are taken when this is called, in one pass over the texts.
    """
    asked = query_tokens(queries, query_key).select(F.col(query_key).alias("query"), "token")
    words = docs.select(
        F.col(doc_key).alias("doc"), tokens(F.coalesce(F.col("text"), F.lit(""))).alias("words")
    )
    pairs = asked.count()
    small = pairs <= broadcast_pairs
    if small:
        counts = corpus_counts(words.select("words"), asked, small)
        best = rank(_by_broadcast(words, asked, counts, k), ["query"], "score", "doc", k)
        named = best.select(F.col("query").alias(query_key), "rank", F.col("doc").alias(doc_key), "score")
    else:
        path = scratch_path(docs.sparkSession, "search-index")
        add_documents(docs, path, 0, doc_key, "text", block_tokens)
        named = search_index(docs.sparkSession, path, queries, k, doc_key, query_key)
    if not fields:
        return named
    results, _, _ = written(named, "search-results")
    return results.join(docs.select(doc_key, *fields), doc_key).select(
        query_key, "rank", doc_key, "score", *fields
    )
