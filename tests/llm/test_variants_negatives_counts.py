"""Spelling variants, hard negatives and token counts against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from agentlake.llm import hard_negatives, resync, spelling
from agentlake.llm.queries import PIECES

BIG = 2**53


def near(a: str, b: str) -> bool:
    """Exactly one insertion, deletion or replacement."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_groups(counts: dict[str, int], times: int) -> list[tuple]:
    partners = {w: [v for v in counts if near(w, v)] for w in counts}
    forms = {}
    for w, others in partners.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, counts[w], len(partners[w]), None if forms[w] is None else counts[forms[w]]))
    return sorted(out)


def groups(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("alphabet,sizes", [("ab", (6, 9)), ("aé", (4, 7)), ("abcdefgh", (6, 7))])
def test_spelling_groups_equal_all_pairs(spark, alphabet, sizes):
    rng = random.Random(len(alphabet) + sizes[0])
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(*sizes))) for _ in range(250)}
    counts = {w: rng.choice([5, 5, 7, 30, 150, 800, 5000]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert groups(spelling.spelling_groups(table)) == plain_groups(counts, 5)


def test_forms_are_followed_to_the_last(spark):
    counts = {"abcdef" + "x" * i: 5**i for i in range(1, 12)}
    found = spelling.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert groups(found) == plain_groups(counts, 5)
    assert {r["root"] for r in found.collect()} == {"abcdef" + "x" * 11}


def plain_words(rows) -> Counter:
    counts = Counter()
    for key, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            code = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if code % spelling.EVERY == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})


def test_words_of_odd_texts(spark, odd_docs, odd_rows):
    rng = random.Random(8)
    own = [(BIG + i, " ".join("".join(rng.choice("abÀÿÖ×") for _ in range(rng.randint(5, 8))) for _ in range(400))) for i in range(20)]
    own += [(None, "Straße STRASSE Übergröße " * 9), (None, None), (BIG, "")] + [(7, "repeated rows count")] * 9
    docs = spark.createDataFrame(own, "doc_id long, text string").withColumns({"run": F.lit("x"), "code": F.lit(1), "word": F.lit("w"), "n": F.lit(2)})
    assert {r["word"]: r["n"] for r in spelling.count_words(docs).collect()} == plain_words(own)
    found = spelling.spelling_variants(odd_docs)
    assert groups(found) == plain_groups(plain_words([(r[0], r[1]) for r in odd_rows]), 5)


def test_spelling_without_words(spark, no_docs):
    assert spelling.spelling_variants(no_docs).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("low,high,dim", [(-160, 160, 64), (-(10**6), 10**6, 33), (-(2**24), 2**24, 5), (0, 3, 3000), (-1, 0, 1)])
def test_scores_are_exact(low, high, dim):
    rng = np.random.default_rng(dim)
    left, right = (rng.integers(low, high, (n, dim), endpoint=True) for n in (7, 11))
    assert (hard_negatives.exact_scores(left, right) == np.array([[sum(int(x) * int(y) for x, y in zip(a, b)) for b in right] for a in left])).all()


def test_scores_at_the_largest_component():
    for dim in (1, 64, 1024):
        most = hard_negatives._largest(dim)
        rows = np.array([[most] * dim, [-most] * dim], np.int64)
        assert hard_negatives.exact_scores(rows, rows).tolist() == [[dim * most**2, -dim * most**2], [-dim * most**2, dim * most**2]]


def plain_hard(rows, anchors) -> list[tuple]:
    """rows: (key, vector, label), usable ones; anchors: positions."""
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    out = []
    for a in anchors:
        key, vector, label = rows[a]
        scored = [
            (-sum(x * y for x, y in zip(whole[a], whole[b])), rows[b][0], rows[b][2] == label)
            for b in range(len(rows))
            if len(rows[b][1]) == len(vector)
        ]
        for best, positive, _ in sorted(s for s in scored if s[2] and s[1] != key)[:5]:
            window = sorted(s for s in scored if not s[2] and 80 * -best <= 100 * -s[0] <= 100 * -best)[:5]
            out += [(key, positive, i + 1, n, -best, -s) for i, (s, n, _) in enumerate(window)]
    return sorted(out)


HARD = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*HARD).collect())


@pytest.mark.parametrize("item_rows,anchor_rows", [(8_192, 4_096), (13, 4)])
def test_hard_negatives_equal_all_scores(spark, item_rows, anchor_rows):
    rng = np.random.default_rng(4)
    rows = [(BIG + i, (rng.normal(size=6) / 4).tolist(), int(rng.integers(3))) for i in range(120)]
    # Ties, equal vectors, one label of a third of the rows, zeros, another length, a long vector.
    rows += [(BIG + 200 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(60)]
    rows += [(BIG + 300 + i, [0.0] * 6, i % 2) for i in range(4)]
    rows += [(BIG + 400 + i, [0.1 * i, 1.0], i % 2) for i in range(9)]
    rows += [(BIG + 500 + i, [30_000.0, -1e-9, 0.0, 0.0, 0.0, 5.0], i % 2) for i in range(4)]
    odd = [
        (None, [1.0] * 6, 1), (BIG + 900, None, 1), (BIG + 901, [1.0] * 6, None), (BIG + 902, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
        (BIG + 903, [math.nan] + [1.0] * 5, 1), (BIG + 904, [math.inf] + [1.0] * 5, 1), (BIG + 905, [1e300] + [1.0] * 5, 1), (BIG + 910, [], 1),
    ]
    schema = "vec_id long, embedding array<double>, label int"
    items = spark.createDataFrame(rows + odd, schema).repartition(5).withColumns({"dim": F.lit("x"), "block": F.lit(0), "id": F.lit("i")})
    anchors = [i for i, r in enumerate(rows) if r[0] % 5 == 0]
    found = hard_negatives.hard_negatives(items, F.col("vec_id") % 5 == 0, item_rows=item_rows, anchor_rows=anchor_rows)
    expected = plain_hard(rows, anchors)
    assert hard(found) == expected and len(expected) > 100


def test_hard_negatives_of_repeated_rows(spark):
    rows = [(i, [1.0 + 0.01 * (i % 7)], i % 2) for i in range(20)] * 2
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = hard_negatives.hard_negatives(items, F.col("vec_id") == 0, item_rows=9)
    assert hard(found) == plain_hard(rows, [0, 20])


def test_hard_negatives_without_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    nothing = hard_negatives.hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 5 == 0)
    assert nothing.columns == list(HARD) and nothing.collect() == []
    alone = spark.createDataFrame([(5, [1.0], 1)], schema)
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 5 == 0).collect() == []
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 5 == 1).collect() == []


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path(PIECES), "rb") as file:
        return file.read()


def odd_long_texts() -> list[str]:
    rng = random.Random(12)
    texts = ["a" * 3_000, " " * 700, "\n\t ▁" * 300, "日本語のテキスト" * 90, "🙂🙃👍🏽" * 120, "é́x" * 500, "<s></s><unk><0x0A>" * 60, "\x00\x01" * 300]
    for alphabet in ("ab", "the an in", "aeiou rst\n", "0123456789", "аб вгд", "▁ a é漢🙂"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(200, 2_500))) for _ in range(6)]
    return texts


def test_counts_are_those_of_whole_texts(spark, model, odd_rows):
    plain = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [r[1] for r in odd_rows] + odd_long_texts()
    rows = [(None if i % 7 == 3 else BIG + 2 * i + 1, t) for i, t in enumerate(texts)] + [(BIG + 1, texts[-1])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({"row": F.lit("r"), "chunk": F.lit(0), "_text": F.lit(1), "_size": F.lit("s"), "n_tokens": F.lit(1)})
    found = resync.count_tokens(docs, model, limit=50, chunk=96, reach=16)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    counts = [len(plain.encode(t or "")) for _, t in rows]
    expected = [(k, len((t or "").encode()), n, n > 50) for (k, t), n in zip(rows, counts)]
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_chunks_align_without_wider_reach(model):
    """Prose splices at the first reach; a run of one letter never does."""
    pieces = resync.Pieces(model)

    def shared(text: str) -> set:
        left, right = pieces.placed(text[:400], 0)[0], pieces.placed(text[300:], 300)[0]
        return set(left[left >= 0]) & set(right[right >= 0])

    assert shared("Words of a plain text, one after the other. " * 20)
    # Runs of one letter fall into pieces from their start on.
    assert all(pieces.placed(t, 0)[2] for t in odd_long_texts())


def test_counts_of_text_ids_and_no_rows(spark, model, no_docs):
    docs = spark.createDataFrame([("x", "a b"), (None, None)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in resync.count_tokens(docs, model).collect()} == {"x": 2, None: 0}
    assert resync.count_tokens(no_docs, model).collect() == []
    with pytest.raises(ValueError):
        resync.count_tokens(docs, model, chunk=32, reach=16)
