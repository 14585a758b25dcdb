"""Mixing, buckets, neighbours, joins, lines and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agentlake.llm import ann, buckets, jaccard, lines, mixing, quality
from agentlake.llm.components import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def chance(doc_id):
    return int(hashlib.md5(f"mix-1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:12], 16) / 2**48


def plain_mix(rows):
    """{source: (size, target)} by sharing and resharing."""
    size = defaultdict(int)
    for _, text, _, source, *_ in rows:
        size[source] += len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = {}, 1.5 * sum(size.values())
    free = set(order)
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] >= 2 * size[s]}
        if not above:
            target |= {s: share * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in above}
        left -= sum(2 * size[s] for s in above)
        free -= above
    return {s: (size[s], target[s]) for s in order}


def test_mix(spark, odd_docs, odd_rows, no_docs):
    plain = plain_mix(odd_rows)
    mixed = mixing.mix_sources(odd_docs)
    for r in mixed.collect():
        size, target = plain[r.source]
        assert r.mix.source_size == size and r.mix.target == pytest.approx(target)
        rate = target / size if size else 0
        assert r.mix.copies == int(rate) + (chance(r.doc_id) < rate - int(rate)) and r.mix.copies <= 2
    again = mixing.repeated(mixing.mix_sources(odd_docs))
    assert again.columns == odd_docs.columns
    assert again.count() == sum(r.mix.copies for r in mixed.collect())
    assert mixing.mix_sources(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.mix.copies for r in mixing.mix_sources(blank).collect()] == [0, 0]


def test_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    mixed = mixing.mix_sources(docs).groupBy("source").agg(
        F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.first("mix.target").alias("target")
    )
    assert all(abs(r.taken - r.target) <= 0.15 * r.target for r in mixed.collect())


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_boundaries_are_optimal(k):
    rng = np.random.default_rng(k)
    lengths = rng.integers(0, 40, 60)
    tops, counts = np.unique(lengths, return_counts=True)
    ends = buckets.best_boundaries(tops, counts, tops * counts, k)
    assert ends[-1] == tops[-1] and len(ends) <= k
    best = min(padding(lengths, [*c, tops[-1]]) for n in range(k) for c in itertools.combinations(tops[:-1].tolist(), n))
    assert padding(lengths, ends) == best


def test_batches(spark, odd_docs, odd_rows, no_docs):
    got = buckets.length_buckets(odd_docs, buckets=4, budget=600).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in odd_rows]
    sizes = {i: len(WORD.findall(t or "")) for i, t, *_ in odd_rows}
    batches = defaultdict(list)
    for r in got:
        assert r.n_words == sizes[r.doc_id] <= r.pad_to and r.padding == r.pad_to - r.n_words
        batches[r.bucket, r.batch].append(r.slot)
        assert len(batches[r.bucket, r.batch]) * r.pad_to <= 600 or len(batches[r.bucket, r.batch]) == 1
    assert all(sorted(s) == list(range(len(s))) for s in batches.values())
    assert buckets.length_buckets(no_docs).count() == 0


def test_bounds_are_the_best_for_long_texts(spark):
    """Above the exact bins, every length a bin of its own."""
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(3_000, 9_000, 40), [500_001, 500_003, 500_003, 1_000_001]])
    rows = [(i, "w " * 1, int(n)) for i, n in enumerate(lengths)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = buckets.length_buckets(docs, buckets=4, length=F.col("n"), exact=None).collect()
    tops = sorted(set(lengths.tolist()))
    best = min(padding(lengths.tolist(), [*c, tops[-1]]) for n in range(4) for c in itertools.combinations(tops[:-1], n))
    assert sum(r.padding for r in got) == best and len(got) == len(rows)


def test_bins_are_bounded_and_hold_their_lengths(spark):
    df = spark.range(0, 200_000, 7).select(F.col("id").alias("n"), buckets.histogram_bin(F.col("id"), 64).alias("bin"))
    rows = df.groupBy("bin").agg(F.min("n").alias("low"), F.max("n").alias("top")).collect()
    assert len(rows) < 64 + 32 * 13 and all(r.bin <= r.low and r.top < r.bin + max(1, r.bin // 32) for r in rows)


def test_neighbours_recall(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    index = ann.build_index(items, "vec_id", "embedding", shard_rows=1000)
    got = defaultdict(list)
    for r in ann.search(index, items.filter("vec_id % 20 = 0"), "vec_id", "embedding").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    rows = items.collect()
    keys = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], dtype=float)
    hits = total = 0
    for q in np.flatnonzero(keys % 20 == 0):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        best = np.lexsort((keys, -score))[:20]
        found = got[keys[q]]
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(abs(s - score[np.flatnonzero(keys == v)[0]]) < 1e-12 for v, s in found)
        hits += len({v for v, _ in found} & set(keys[best].tolist()))
        total += 20
    assert hits >= 0.9 * total


def recall_of(spark, vectors: np.ndarray, shard_rows: int) -> float:
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    index = ann.build_index(df, "vec_id", "embedding", shard_rows=shard_rows)
    asked = df.filter("vec_id % 100 = 0")
    got = defaultdict(set)
    for r in ann.search(index, asked, "vec_id", "embedding").collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, len(vectors), 100):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score, kind="stable")[:20].tolist()))
    return hits / (20 * len(got))


@pytest.mark.parametrize("kind", ["lognormal", "outlier", "normal"])
def test_recall_whatever_the_lengths(spark, kind):
    """At the registered shard size; the normal components have no structure at all."""
    rng = np.random.default_rng(2)
    if kind == "normal":
        assert recall_of(spark, rng.normal(size=(6_000, 64)), ann.SHARD_ROWS) >= 0.9
        return
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    vectors = np.array([r.embedding for r in rows], float)
    if kind == "outlier":
        vectors[3] *= 1e6
    else:
        vectors *= rng.lognormal(size=(len(vectors), 1))
    assert recall_of(spark, vectors, ann.SHARD_ROWS) >= 0.9


def test_extreme_vectors(spark):
    """Neither huge nor tiny finite components break anything; products that leave the range are infinite."""
    rows = [(0, [1e200, 1.0]), (1, [1e200, 0.0]), (2, [1e-200, 0.0]), (20, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [-1e200, 5e-324])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(ann.build_index(df, "vec_id", "embedding"), df.filter("vec_id % 20 = 0"), "vec_id", "embedding").orderBy("rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {0: [1, 3, 2, 20, 4], 20: [0, 1, 3, 2, 4]}


def test_large_ids_of_queries_stay_whole(spark):
    rows = [(2**53 + 1 + 2 * i, [1.0, (i + 1) / 40]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(ann.build_index(df, "vec_id", "embedding"), df, "vec_id", "embedding", k=1).collect()
    assert {r.query_id: r.vec_id for r in found} == {k: rows[-1][0] if k != rows[-1][0] else rows[-2][0] for k, _ in rows}


def test_neighbours_among_copies(spark):
    """A third of all rows are one vector; ties go to the smaller keys."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1500, 8))
    vectors[rng.permutation(1500)[:500]] = vectors[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    index = ann.build_index(df, "vec_id", "embedding", shard_rows=600)
    got = defaultdict(list)
    for r in ann.search(index, df.filter("vec_id % 20 = 0"), "vec_id", "embedding").orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    hits = 0
    for q in range(0, 1500, 20):
        score = np.round(vectors @ vectors[q], 9)
        score[q] = -np.inf
        best = np.lexsort((np.arange(1500), -score))[:20]
        hits += len(set(got[q]) & set(best.tolist()))
        if (vectors[q] == vectors[0]).all():
            assert got[q] == best.tolist()
    assert hits >= 0.95 * 20 * len(got)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [3.0, 0.0]), (3, [-1.0, 0.0]), (4, None), (5, [0.0, 0.0]),
            (40, [nan, 1.0]), (6, [inf, 1.0]), (60, [1.0, None]), (80, [1.0, 2.0, 3.0]), (7, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (100, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(ann.build_index(df, "vec_id", "embedding"), df.filter("vec_id % 20 = 0"), "vec_id", "embedding").orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {0: [(2, 3.0), (1, 1.0), (20, 0.5), (3, -1.0)], 20: [(2, 1.5), (0, 0.5), (1, 0.5), (3, -0.5)], 80: [(7, 1.0)]}
    none = df.filter("false")
    assert ann.search(ann.build_index(none, "vec_id", "embedding"), none, "vec_id", "embedding").count() == 0


def shingles(text, n=3):
    words = lower(text or "").split(" ")
    words = WORD.findall(lower(text or ""))
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1)))}


def plain_groups(pairs, percent=90):
    sets = {i: shingles(t) for i, t in pairs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("task_elements", [2_000_000, 150])
def test_groups(spark, odd_docs, odd_rows, task_elements):
    plain = plain_groups([r[:2] for r in odd_rows])
    found, links = jaccard.jaccard_groups(odd_docs, task_elements=task_elements, sketch=1 << 12)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain
    sets = {i: shingles(t) for i, t, *_ in odd_rows}
    assert links.count() > 0 and all(plain[r.a][1] == plain[r.b][1] and sets[r.a] != sets[r.b] for r in links.collect())


def test_large_group_of_variants(spark):
    base = [f"t{i}" for i in range(90)]
    texts = [(i, " ".join(base[: 10 + i % 70] + [f"u{i}"] + base[10 + i % 70 :])) for i in range(150)] + [(200, "x y z"), (201, "X y  z")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for task_elements in (2_000_000, 2_000):
        found, _ = jaccard.jaccard_groups(df, task_elements=task_elements, sketch=1 << 12)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain_groups(texts)


def test_groups_of_odd_ids(spark, no_docs):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, None), (7, ""), (None, "q q q q q")]
    found, _ = jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert got == sorted([(None, 2, 5), (5, 2, 5), (5, 2, 5), (None, 0, None), (7, 0, 7), (None, 1, None)], key=str)
    found, links = jaccard.jaccard_groups(no_docs)
    assert found.count() == links.count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(60, 60), (71, 70), (70, 71)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 130)}, 70: 70, 71: 70}


def plain_lines(pairs, shortest=10):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= shortest:
                holders[key(line)].add(i)
    out = {}
    for i, t in pairs:
        parts = (t or "").split("\n")
        kept = [p for p in parts if not (len(holders.get(key(p), ())) > 1 and min(holders[key(p)]) < i)]
        out[i] = (len(parts), len(parts) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_lines(spark, odd_docs, odd_rows, batches):
    got = lines.dedup_lines(odd_docs, batches=batches, fanout=2).collect()
    assert {r.doc_id: tuple(r.lines) for r in got} == plain_lines([r[:2] for r in odd_rows])
    assert all(r.h == "h" and r._row == "_row" for r in got)


def test_lines_of_odd_ids(spark, no_docs):
    line = "a line that is long"
    rows = [(2, line), (2, line + "\n" + line), (None, line.upper() + "\nx"), (1, "\t" + line + " \nshort"), (None, None)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), batches=2).collect()
    kept = sorted(((r.doc_id, r.text, r.lines.n_dropped, r.lines.kept) for r in got), key=str)
    assert kept == sorted(
        [(2, line, 1, ""), (2, line + "\n" + line, 2, ""), (None, line.upper() + "\nx", 1, "x"), (1, "\t" + line + " \nshort", 0, "\t" + line + " \nshort"), (None, None, 0, "")],
        key=str,
    )
    assert lines.dedup_lines(no_docs).count() == 0


def test_runs_are_compacted(spark):
    store = lines.LineStore(spark, fanout=2)
    for b in range(4):
        batch = spark.range(b * 10, b * 10 + 10).select(F.col("id").alias("doc_id"), (F.col("id") % 15).alias("h"), F.lit(0).alias("g"))
        known = {r.h: r.owner for r in store.add(batch).collect()}
        assert known == {h % 15: h % 15 for h in range(b * 10, b * 10 + 10) if h >= 15}
        store.compact()
    assert [len(level) for level in store.levels] == [0, 0, 1]
    assert sum(r.count() for r in store.runs()) == 15
    store.close()


def test_pipeline_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    refs = quality.references(docs)
    kept = quality.judge_quality(docs, refs).filter("quality.kept").select("doc_id", "text", "lang", "source").collect()
    pairs = [(r.doc_id, r.text) for r in kept]
    texts = {i: v[2] for i, v in plain_lines(pairs).items()}
    groups = plain_groups(list(texts.items()))
    source = {r.doc_id: r.source for r in kept}
    rest = [(i, texts[i], None, source[i]) for i in texts if groups[i][0] == 0 or groups[i][1] == i]
    plain = plain_mix(rest)
    expected = defaultdict(int)
    for i, text, _, s in rest:
        size, target = plain[s]
        rate = target / size if size else 0
        copies = int(rate) + (chance(i) < rate - int(rate))
        if copies:
            expected[i, len(WORD.findall(text))] = copies
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r.doc_id, r.n_words] += 1
        assert r.n_words + r.padding == r.pad_to
    assert got == expected


def test_stages_keep_columns_and_take_nothing(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, no_docs, SMALL).columns == no_docs.columns, name
        assert stage(spark, no_docs, SMALL).count() == 0
        got = stage(spark, odd_docs, SMALL)
        assert got.columns == odd_docs.columns and got.count() >= 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, SMALL).count() == odd_docs.count()


def test_ids_beside_null_ids_stay_whole(spark):
    rng = random.Random(6)
    keys = [2**53 + 1, None, 2**53 + 3, 2**63 - 1, 2**53 + 5, None]
    rows = [(k, " ".join(f"w{rng.randint(0, 500)}" for _ in range(80)), "en", "s", 1) for k in keys]
    # A copy of the first, under an id that a double could not tell from it.
    rows.append((2**53 + 2, rows[0][1], "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    found, links = jaccard.jaccard_groups(docs)
    groups = {r.doc_id: r.component_id for r in found.filter("doc_id IS NOT NULL").collect()}
    assert groups == {k: (2**53 + 1 if k == 2**53 + 2 else k) for k, *_ in rows if k is not None}
    whole = sorted(map(str, keys))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        kept = stage(spark, docs, "")
        got = sorted({str(r.doc_id) for r in kept.collect()})
        expected = set(whole) if name == "near duplicates" else {str(r[0]) for r in rows}
        assert got == sorted(expected) if name != "source mix" else set(got) <= expected
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == set(keys)
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 6
    slots = corpus_pipeline.length_buckets(spark, docs, "")
    assert sorted(str(r.doc_id) for r in slots.collect()) == sorted(str(r[0]) for r in rows)
