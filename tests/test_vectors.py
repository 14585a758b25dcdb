from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from agentlake.functions.vectors import dot
from agentlake.operators import search, searchindex, vectors
from agentlake.plans import agents


def vector_table(spark, n, dim, seed, prefix="v"):
    rng = np.random.default_rng(seed)
    data = [(f"{prefix}{i:03d}", [float(x) for x in rng.integers(-3, 4, dim)]) for i in range(n)]
    return spark.createDataFrame(data, "key string, embedding array<float>"), data


def brute(queries, items, k, same=False):
    found = []
    for q, a in queries:
        scored = sorted((-round(float(np.dot(a, b)), 6), i) for i, b in items if not (same and i == q))
        found += [(q, i, -s, n + 1) for n, (s, i) in enumerate(scored[:k])]
    return sorted(found)


def test_top_match_both_ways(spark):
    left, lq = vector_table(spark, 90, 5, 1, "q")
    right, li = vector_table(spark, 70, 5, 2, "i")
    for k in (1, 4, 100):
        want = brute(lq, li, k)
        near = vectors.top_match(left, right, "key", "key", k=k)
        far = vectors.top_match(left, right, "key", "key", k=k, broadcast_bytes=0, block_rows=16)
        assert sorted(map(tuple, near.collect())) == want
        assert sorted(map(tuple, far.collect())) == want


def test_self_is_left_out(spark):
    table, data = vector_table(spark, 40, 4, 3)
    want = brute(data, data, 2, same=True)
    for options in ({}, {"broadcast_bytes": 0, "block_rows": 8}):
        found = vectors.top_match(table, table, "key", "key", k=2, exclude_self=True, **options)
        assert sorted(map(tuple, found.collect())) == want


def test_no_items_no_matches(spark):
    table, _ = vector_table(spark, 4, 3, 1)
    assert vectors.top_match(table, table.filter("false"), "key", "key").count() == 0
    one = table.filter("key = 'v000'")
    assert vectors.top_match(one, one, "key", "key", exclude_self=True).count() == 0


def test_dot_sums_in_double(spark):
    df = spark.createDataFrame([([1e8, 1.0, -1e8], [1.0, 1.0, 1.0])], "a array<float>, b array<float>")
    assert df.select(dot(F.col("a"), F.col("b")).alias("d")).first().d == 1.0


def test_embedding(spark):
    df = spark.createDataFrame([("b b a",), ("",), (None,), ("Éa 1",)], "text string")
    found = [r.embedding for r in vectors.embed(df, "text", dim=64).collect()]
    assert [round(math.hypot(*v), 5) for v in found] == [1.0, 0.0, 0.0, 1.0]
    assert sorted(round(x, 4) for x in found[0] if x) == [0.4472, 0.8944]

    def lengths(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(lambda t: [float(len(t))])

    assert [r.embedding for r in vectors.embed(df, "text", fn=lengths).collect()] == [[5.0], [0.0], [0.0], [4.0]]


def test_tasks_find_their_agent(spark):
    cards = spark.createDataFrame(
        [("u/air", '{"name": "air ticketing", "tags": ["book air tickets"]}'), ("u/car", '{"name": "car rental"}')],
        "card_uri string, agent_card string",
    )
    tasks = spark.createDataFrame([(1, "Book return air tickets"), (2, "rent a car")], "task_id long, description string")
    found = agents.assign_agents(tasks, agents.index_cards(cards))
    assert {r.task_id: r.card_uri for r in found.collect()} == {1: "u/air", 2: "u/car"}


# --- search -------------------------------------------------------------------

DOCS = [
    (1, "the cat sat on the mat"), (2, "the dog"), (3, ""), (4, "cat cat cat"), (5, "a dog and a cat"),
    (6, "unrelated words here"), (7, None), (8, "the the the the"), (9, "dog dog mat"),
]
QUERIES = [(10, "cat dog"), (11, "the"), (12, "nothing matches zebra"), (13, "mat the mat")]


def bm25(docs, queries, k):
    words = {d: re.findall(r"\w+", (t or "").lower()) for d, t in docs}
    mean = sum(map(len, words.values())) / len(words)
    df = Counter(t for ws in words.values() for t in set(ws))
    found = []
    for q, text in queries:
        scores = []
        for d, ws in words.items():
            score = 0.0
            for t in set(text.split()):
                tf = ws.count(t)
                idf = math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5))
                score += idf * tf * (search.K1 + 1) / (tf + search.K1 * (1 - search.B + search.B * len(ws) / mean))
            if score > 0:
                scores.append((-round(score, 6), d))
        found += [(q, n + 1, d, -s) for n, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def test_search_both_ways(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(QUERIES, "query_id long, text string")
    for k in (1, 3, 10):
        want = bm25(DOCS, QUERIES, k)
        near = search.text_search(docs, queries, k)
        far = search.text_search(docs, queries, k, broadcast_pairs=0, block_tokens=8)
        assert sorted(map(tuple, near.collect())) == want
        assert sorted(map(tuple, far.collect())) == want


def test_search_field_mask_and_no_documents(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("name", F.lit("n"))
    queries = spark.createDataFrame(QUERIES, "query_id long, text string")
    assert search.text_search(docs, queries, fields=["name"]).columns == ["query_id", "rank", "doc_id", "score", "name"]
    assert search.text_search(docs.filter("false"), queries).count() == 0
    assert search.text_search(docs, queries.filter("query_id = 12")).count() == 0


def random_texts(rng, n, first=0):
    """Words of very unequal frequency; empty and NULL texts among them."""
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [
        (first + i, rng.choice([None, ""]) if i % 17 == 5 else " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 30))))
        for i in range(n)
    ]


def test_index_of_segments_equals_the_scan(spark, tmp_path):
    """Shards and segments of few words; a segment written again replaces itself."""
    rng = random.Random(4)
    docs, later = random_texts(rng, 400, 2**53), random_texts(rng, 150, 2**53 + 400)
    queries = [(q, " ".join(rng.choices([f"w{i}" for i in range(70)], k=rng.randint(1, 6)))) for q in range(12)]
    path, schema = str(tmp_path / "index"), "doc_id long, text string"
    asked = spark.createDataFrame(queries, "query_id long, text string")
    for _ in range(2):
        searchindex.add_documents(spark.createDataFrame(docs, schema).repartition(3), path, 0, shard_words=900)
    for k in (1, 7):
        assert sorted(map(tuple, searchindex.search_index(spark, path, asked, k).collect())) == bm25([(d, t or "") for d, t in docs], queries, k)
    searchindex.add_documents(spark.createDataFrame(later, schema), path, 1, shard_words=900)
    both = [(d, t or "") for d, t in docs + later]
    assert sorted(map(tuple, searchindex.search_index(spark, path, asked, 10).collect())) == bm25(both, queries, 10)
    plan = searchindex.search_index(spark, path, asked, 10)._jdf.queryExecution().toString()
    assert "text" not in plan.split("Physical Plan")[-1]


def test_blocks_below_the_best_are_not_visited():
    rng = np.random.default_rng(1)
    lengths = rng.integers(5, 60, 64 * 400)
    shard = searchindex.Shard(np.arange(len(lengths)), lengths, float(lengths.mean()))
    exact = np.zeros(len(lengths))
    words, idf = ["a", "b"], np.array([0.4, 6.0])
    for word, weight, share in zip(words, idf, (0.5, 0.002)):
        docs = np.flatnonzero(rng.random(len(lengths)) < share)
        counts = rng.integers(1, 4, len(docs))
        block = docs // searchindex.BLOCK_DOCS
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        lists = (docs, counts, block[starts], starts, np.maximum.reduceat(counts, starts), np.minimum.reduceat(lengths[docs], starts))
        shard.add({"token": word, **dict(zip(searchindex._LISTS, lists))})
        exact[docs] += weight * (counts * (search.K1 + 1) / (counts + shard.norm[docs]))
    found, scores = shard.best(words, idf, 10)
    exact = np.round(exact, 6)
    best = np.lexsort((np.arange(len(exact)), -exact))[:10]
    assert found.tolist() == best.tolist() and np.allclose(scores, exact[best])
    assert shard.visited < shard.seen / 2


def test_an_empty_index_has_no_hits(spark, tmp_path):
    path, queries = str(tmp_path / "index"), spark.createDataFrame([("q", "a b")], "query_id string, text string")
    searchindex.add_documents(spark.createDataFrame([(None, "a b")], "doc_id string, text string"), path, 0)
    assert searchindex.search_index(spark, path, queries).collect() == []
    searchindex.add_documents(spark.createDataFrame([("x", "a c"), ("y", None)], "doc_id string, text string"), path, 1)
    assert [r.doc_id for r in searchindex.search_index(spark, path, queries).collect()] == ["x"]


def test_groups_that_cannot_win_are_left_out(spark, caplog):
    """Clustered vectors: the rows of the direct way, and most groups unvisited."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 4
    data = np.round(centres[rng.integers(12, size=900)] + rng.normal(size=(900, 8)) * 0.2, 3)
    rows = [(2**53 + i, v.tolist()) for i, v in enumerate(data)] + [(7, [float("nan")] * 8), (8, [float("inf")] + [0.0] * 7), (9, None)]
    table = spark.createDataFrame(rows, "key long, embedding array<double>").repartition(4)
    queries = table.filter("key % 9 = 0 OR key < 100")
    for k, same in ((1, True), (5, False)):
        with caplog.at_level("INFO", logger="agentlake.operators.vectors"):
            far = vectors.top_match(queries, table, "key", "key", k=k, exclude_self=same, broadcast_bytes=0, block_rows=40)
        near = vectors.top_match(queries, table, "key", "key", k=k, exclude_self=same)
        assert sorted(map(tuple, far.collect())) == sorted(map(tuple, near.collect()))
        further, of = map(int, re.search(r"(\d+) further visits of (\d+) groups", caplog.records[-1].getMessage()).groups())
        assert of > 15 and further < 0.5 * of * queries.count()


def test_two_precisions_give_the_plain_order(monkeypatch):
    """Small chunks; ties, equal keys, numbers beyond single precision, and vectors without one."""
    monkeypatch.setattr(vectors, "CHUNK_ROWS", 16)
    monkeypatch.setattr(vectors, "CHUNK_ITEMS", 32)
    rng = np.random.default_rng(2)
    near = rng.normal(size=(300, 6))
    tied = np.repeat(rng.integers(-2, 3, (60, 6)).astype(float), 5, axis=0)
    odd = near.copy()
    odd[7], odd[40, 2], odd[90] = np.nan, np.inf, 1e200
    for data in (near, near * 1e-3, near.astype(np.float32), tied, odd, np.zeros((300, 6)), 1000 + near):
        keys = np.sort(rng.choice(280, len(data))) if data is tied else np.arange(len(data))
        for k, same in ((1, True), (5, False), (5, True), (400, True)):
            with np.errstate(all="ignore"):
                scores = np.round(data.astype(float) @ data.T.astype(float), 6) + 0.0
                found = vectors._best(keys, data.astype(float), keys, data, k, same)
            scores[~np.isfinite(scores)] = -np.inf
            if same:
                scores[keys[:, None] == keys[None, :]] = -np.inf
            chosen = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            best = np.take_along_axis(scores, chosen, axis=1)
            row, nth = np.nonzero(best > -np.inf)
            assert found["query"].tolist() == keys[row].tolist() and found["item"].tolist() == keys[chosen[row, nth]].tolist()
            assert np.allclose(found["score"], best[row, nth], atol=2e-6)


def test_where_no_group_is_left_out_queries_are_not_copied(spark, monkeypatch):
    """Vectors without clusters, where every query meets every group: no table has a row for each such pair."""
    rng, sizes, original = np.random.default_rng(3), {}, vectors.written

    def counted(df, name, *rest):
        kept = original(df, name, *rest)
        sizes[name] = kept[0].count()
        return kept

    monkeypatch.setattr(vectors, "written", counted)
    for name, value in (("MEETING_QUERIES", 90), ("MEETING_ITEMS", 150)):
        monkeypatch.setattr(vectors, name, value)
    data = [(2**53 + i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 16)))]
    table = spark.createDataFrame(data, "key long, embedding array<float>").repartition(3)
    far = vectors.top_match(table, table, "key", "key", k=5, exclude_self=True, broadcast_bytes=0, block_rows=20)
    near = vectors.top_match(table, table, "key", "key", k=5, exclude_self=True)
    assert sorted(map(tuple, far.collect())) == sorted(map(tuple, near.collect()))
    # Rows of best items: five for each query; groups: about 80, met by five slices.
    assert sizes["vector-groups"] > 40 and max(sizes.values()) <= 5 * 400


def test_shards_are_cut_inside_a_batch(spark, tmp_path):
    """All documents come in one batch; no shard holds more words than asked for and one document."""
    docs = [(i, " ".join(f"w{(i * j) % 50}" for j in range(1, 21))) for i in range(300)]
    path = str(tmp_path / "index")
    searchindex.add_documents(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), path, 0, shard_words=500)
    heads = spark.read.parquet(path).filter("kind = 0").select("n", "words", "shard").collect()
    assert sum(r.n for r in heads) == 300 and max(r.words for r in heads) <= 500 + 20
    assert len({r.shard for r in heads}) == len(heads) == 12
