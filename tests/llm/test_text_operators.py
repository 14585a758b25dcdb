"""Packs, language model, languages, quality and URLs against plain versions."""

from __future__ import annotations

import base64
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agentlake.llm import language, lm, quality, token_packs, urls
from agentlake.llm.elias_fano import EliasFano, Level
from agentlake.llm.queries import RANKS, URL_RULES
from agentlake.llm.text import word_count

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def ranks():
    path = RANKS.removeprefix("file://")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}


def test_word_count(spark, odd_docs, odd_rows):
    got = {r.doc_id: r.n for r in odd_docs.select("doc_id", word_count(F.col("text")).alias("n")).collect()}
    assert got == {i: len(WORD.findall(t or "")) for i, t, *_ in odd_rows}


def test_encoder_is_exact(ranks, odd_rows):
    encoder = token_packs.Encoder(ranks)
    texts = [t or "" for _, t, *_ in odd_rows] + ["a  b", "a \n b", " x", "x ", "  ", "a\u2003 b", "it 's don't", "1 2  3\n\n x\t y"]
    got = encoder([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [encoder.encode(t) for t in texts]


def test_packs_round_trip(spark, odd_docs, odd_rows, ranks, no_docs):
    encode = token_packs.Encoder(ranks).encode
    packs = token_packs.pack_tokens(odd_docs, ranks, length=128, block_ids=3000).collect()
    pieces = defaultdict(dict)
    for p in packs:
        ids, at = np.frombuffer(p.ids, "<u2"), np.frombuffer(p.positions, "<u2")
        assert len(ids) == len(at) == 128 and p.cu_seqlens[0] == 0 and p.cu_seqlens[-1] == p.n_ids <= 128
        assert (ids[p.n_ids :] == token_packs.END).all() and (at[p.n_ids :] == 0).all()
        for a, b, doc, off in zip(p.cu_seqlens, p.cu_seqlens[1:], p.doc_ids, p.offsets):
            assert at[a:b].tolist() == list(range(b - a))
            pieces[doc][off] = ids[a:b].tolist()
    whole = {d: sum((v for _, v in sorted(p.items())), []) for d, p in pieces.items()}
    assert whole == {i: encode(t or "") + [token_packs.END] for i, t, *_ in odd_rows}
    assert token_packs.pack_tokens(no_docs, ranks).count() == 0


def test_best_fit_decreasing_takes_the_fullest_row():
    rng = random.Random(1)
    sizes = [rng.randint(1, 64) for _ in range(400)]
    rows = token_packs.best_fit_decreasing(sizes, 64)
    assert sorted(i for r in rows for i in r) == list(range(400))
    assert all(sum(sizes[i] for i in r) <= 64 for r in rows)
    left: list[int] = []
    for size in sorted(sizes, reverse=True):
        fits = [c for c in left if c >= size]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - size)
        else:
            left.append(64 - size)
    assert len(rows) == len(left)


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 10**12), (512, 10**6), (1025, 900), (5000, 10**9)):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        coded = EliasFano(EliasFano.encode(values))
        for a, b in [(0, n), *map(sorted, rng.integers(0, n + 1, (20, 2)).tolist())]:
            assert (coded.slice(a, b) == values[a:b]).all()


def test_level_finds_children():
    rng = np.random.default_rng(2)
    contexts, words = (np.unique(rng.integers(0, 10**6, 300)).astype(np.uint64) for _ in range(2))
    pairs = np.unique(rng.integers(0, len(contexts) * len(words), 4000))
    c, w = pairs // len(words), pairs % len(words)
    level = Level(Level.encode(contexts, words, c, w, -rng.random(len(pairs))))
    asked = np.concatenate([contexts[c], rng.integers(0, 10**6, 300).astype(np.uint64)])
    about = np.concatenate([words[w], words[rng.integers(0, len(words), 300)]])
    order = np.argsort(asked, kind="stable")
    place = {(int(a), int(b)): i for i, (a, b) in enumerate(zip(contexts[c], words[w]))}
    got = level.find(asked[order], about[order], chunk=50)
    assert got.tolist() == [place.get((int(a), int(b)), -1) for a, b in zip(asked[order], about[order])]


def scored(rows, order, discount=0.75):
    docs = [(i, (t or "").encode().lower().split() + [None], zlib.crc32(str(i).encode()) % 5 == 1) for i, t, *_ in rows]
    counts = [Counter() for _ in range(order + 1)]
    for _, t, held in docs:
        if not held:
            for k in range(1, order + 1):
                counts[k].update(tuple(t[j : j + k]) for j in range(len(t) - k + 1))
    total, kinds = sum(counts[1].values()), len(counts[1])
    kept = [{} for _ in range(order + 1)]
    given = [defaultdict(float) for _ in range(order + 1)]
    for k in range(2, order + 1):
        for g, c in counts[k].items():
            if k == 2 or (counts[k - 1][g[:-1]] >= 2 and counts[k - 1][g[1:]] >= 2):
                kept[k][g] = c
                given[k][g[:-1]] += max(c - discount, 0)
    for i, t, held in docs:
        score = base = known = 0
        for j, w in enumerate(t):
            c = counts[1][(w,)]
            known += c > 0
            base += math.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
            p = max(c - discount, 0) / total + discount * kinds / total / (kinds + 1)
            for k in range(2, order + 1):
                context = tuple(t[j - k + 1 : j]) if j >= k - 1 else None
                if context is None or not c or counts[k - 1][context] < (1 if k == 2 else 2):
                    break
                if k > 2 and counts[k - 1][tuple(t[j - k + 2 : j + 1])] < 2:
                    break
                n = counts[k - 1][context]
                p = max(kept[k].get((*context, w), 0) - discount, 0) / n + (1 - given[k][context] / n) * p
            score += math.log10(p)
        yield i, (held, len(t), known, total, base, score)


@pytest.mark.parametrize("order", [2, 3])
def test_scores_match_a_plain_model(spark, odd_docs, odd_rows, order):
    plain = dict(scored(odd_rows, order))
    got = lm.score_documents(odd_docs, order=order, block_tokens=900, shard_entries=500).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        held, n, known, total, base, score = plain[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base) and abs(r.score - score) <= 0.03 * n


def test_scores_of_nothing_and_of_held_out_rows_only(spark, no_docs):
    assert lm.score_documents(no_docs).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    only = spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string")
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in lm.score_documents(only).collect()} == {(3, 0, 0), (1, 0, 0)}


BIG = 2**53


def big_rows() -> list[tuple]:
    """Ids that no double holds, beside NULL ids."""
    rng = random.Random(6)
    keys = [BIG + 1, None, BIG + 3, 2**63 - 1, -(2**63) + 1, None, BIG + 5]
    return [(k, " ".join(f"w{rng.randint(0, 500)}" for _ in range(80))) for k in keys]


def test_ids_beside_null_ids_stay_whole(spark, ranks):
    rows = big_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    keys = sorted((k for k, _ in rows), key=str)
    packs = token_packs.pack_tokens(docs, ranks).collect()
    assert sorted((k for p in packs for k in p.doc_ids), key=str) == keys
    for order in (2, 3):
        assert sorted((r.doc_id for r in lm.score_documents(docs, order=order).collect()), key=str) == keys
    assert lm.score_documents(docs.filter("doc_id IS NULL")).filter("doc_id IS NULL").count() == 2


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(docs.filter(~held))
    got = language.identify(docs.filter(held), model).select("lang", "language.*").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_texts(spark, odd_docs, odd_rows, no_docs):
    model = language.fit(odd_docs)
    got = {r.doc_id: r.l for r in language.identify(odd_docs, model, out="l").select("doc_id", "l").collect()}
    for i, t, *_ in odd_rows:
        letters = any(c.isalpha() for c in t or "")
        assert (got[i].lang_pred in ("en", "fr")) == letters and (got[i].lang_pred == "und") != letters
    nothing = language.fit(no_docs)
    assert {r.l.lang_pred for r in language.identify(odd_docs, nothing, out="l").select("l").collect()} == {"und"}


def test_numerals_and_marks_are_no_letters(spark, odd_docs):
    model = language.fit(odd_docs)
    texts = ["10² ½", "Ⅷ", "①", "_", "٣", "x²", "½ é", "𝒳"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.language for r in language.identify(docs, model).collect()}
    for t in texts:
        letters = any(unicodedata.category(c).startswith("L") for c in t)
        assert (got[t].lang_pred != "und") == letters and (letters or got[t].score == 0)


def test_every_label_can_be_predicted(spark):
    rng = random.Random(3)
    vocabulary = {f"l{i:03}": ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(6)] for i in range(250)}
    rows = [(10 * i + k, " ".join(v), lang) for i, (lang, v) in enumerate(vocabulary.items()) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(docs, language.fit(docs)).select("lang", "language.lang_pred").collect()
    assert all(r.lang == r.lang_pred for r in found)


def test_unseen_words_fall_back_to_pieces():
    table = {5: {}, 4: {}, 3: {" ab": 0}, 2: {}, 1: {"z": 1}}
    model = {"names": ["x", "y"], "prior": np.zeros(2), "tables": {0: {}, **table}, "matrix": np.array([[-1.0, -5.0], [-9.0, -2.0]])}
    scorer = language.Scorer(model)
    assert scorer.pieces("abq").tolist() == [-1.0, -5.0]
    assert scorer.pieces("qz").tolist() == [-9.0, -2.0]
    assert scorer.pieces("q") is None


def plain_counts(text):
    tokens = WORD.findall(text or "")
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(tokens), sum(map(len, tokens)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, odd_docs, odd_rows, no_docs):
    refs = quality.references(odd_docs)
    got = {r.doc_id: r.q for r in quality.judge_quality(odd_docs, refs, out="q").select("doc_id", "q").collect()}
    for i, t, *_ in odd_rows:
        n, chars, symbols, lines, repeated = plain_counts(t)
        q = got[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert q.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (q.base_failed and q.kept)
    assert quality.judge_quality(no_docs, quality.references(no_docs)).count() == 0


def plain_class(c):
    if c == "\n":
        return "newline"
    for name, members in (("space", " \t\x0b\x0c\r"), ("point", ".,;:!?'\"()-"), ("symbol", "#*$%&|<>"), ("digit", "0123456789")):
        if c in members:
            return name
    if not c.isascii():
        return "non-ascii"
    return "lower" if c.islower() else "upper" if c.isupper() else "other ascii"


def plain_words(text):
    return [w.encode().lower() for w in WORD.findall(text or "")]


def plain_distance(p, q):
    far = 0.0
    for k in {*p, *q}:
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        far += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x)
    return math.sqrt(max(far / 2, 0.0))


def shares(counts):
    total = sum(counts.values())
    return {k: n / total for k, n in counts.items()} if total else {}


def plain_references(rows, least_words, least_share):
    """rows: (text, lang). Pairs (class shares, word shares) by reference name."""
    sizes = Counter()
    for text, lang in rows:
        sizes[lang or ""] += len(plain_words(text))
    own = {k for k, n in sizes.items() if n >= least_words and n >= least_share * sum(sizes.values())}
    classes, words = defaultdict(Counter), defaultdict(Counter)
    for text, lang in rows:
        name = lang if lang in own else ""
        classes[name].update(map(plain_class, text or ""))
        words[name].update(plain_words(text))
    made = {}
    for name, counted in words.items():
        if counted.total() >= least_words:
            top = dict(sorted(counted.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON])
            made[name] = shares(classes[name]), shares({**top, None: counted.total() - sum(top.values())})
    return made


def plain_quality(text, refs):
    """(char distance, word distance, how far the nearer limit is, kept)."""
    words, chars = plain_words(text), Counter(map(plain_class, text or ""))
    far_char = min(plain_distance(shares(chars), c) for c, _ in refs.values())
    far_word = math.inf
    for _, listed in refs.values():
        counted = Counter(w if w in listed else None for w in words)
        # An empty text is half of every reference away.
        far_word = min(far_word, plain_distance(shares(counted), listed))
    n, size, repeated = len(words), len(text or ""), plain_counts(text)[4]
    room = math.inf
    if size >= quality.LEAST_CHARS:
        room = min(room, quality.CHAR_LIMIT + quality.CHAR_SLACK / math.sqrt(size) - far_char)
    if n >= quality.LEAST_WORDS:
        room = min(room, quality.WORD_LIMIT + quality.WORD_SLACK / math.sqrt(n) - far_word)
    return far_char, far_word, room, not (n < 50 or 100 * repeated > 50 * n) and room >= 0


def assert_judged(docs, rows, least_words, least_share, every=1):
    refs = quality.references(docs, least_words=least_words, least_share=least_share)
    plain = plain_references([(t, lang) for _, t, lang in rows], least_words, least_share)
    assert {r["lang"] for r in refs} == set(plain)
    got = {r.doc_id: r.q for r in quality.judge_quality(docs, refs, out="q").select("doc_id", "q").collect()}
    assert len(got) == len(rows)
    verdicts = set()
    for i, text, _ in rows[::every]:
        far_char, far_word, room, kept = plain_quality(text, plain)
        assert got[i].char_distance == pytest.approx(far_char, abs=1e-7), i
        assert got[i].word_distance == pytest.approx(far_word, abs=1e-7), i
        if abs(room) > 1e-6:
            assert got[i].kept == kept, i
            verdicts.add(kept)
    return verdicts


def test_verdicts_equal_a_plain_version(spark, odd_docs, odd_rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    assert assert_judged(docs, [tuple(r) for r in docs.collect()], quality.REFERENCE_WORDS, quality.LEAST_SHARE) == {True, False}
    assert_judged(odd_docs, [r[:3] for r in odd_rows], 100, 0.0)


def test_rare_languages_are_added_up_whole(spark):
    """A word that is common only in the pool, and more languages than ever fit a fixed number."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        own = [f"l{i}w{k}" for k in range(260)]
        words = [w for w in own for _ in range(2)] + ["shared"]
        if i < 250:
            words = words * 4
        rng.shuffle(words)
        rows.append((i, " ".join(words), f"lang{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    refs = {r["lang"]: r for r in quality.references(docs, least_words=2_000)}
    assert len(refs) == 251
    pool = refs[quality.POOLED]
    assert pool["shares"][pool["words"].index(b"shared")] == pytest.approx(50 / (50 * 521))
    assert_judged(docs, rows, 2_000, quality.LEAST_SHARE, every=40)


def test_distance_is_jensen_shannon():
    p, q = np.array([0.2, 0.3, 0.5]), np.array([0.6, 0.0, 0.4])
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    assert quality.distance(100 * p[None], q)[0] == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2))


def test_quality_keeps_good_and_drops_bad(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 0")
    judged = quality.judge_quality(docs, quality.references(docs), out="q").filter("NOT q.base_failed").join(labels, "doc_id")
    share = {r.quality: r.k for r in judged.groupBy("quality").agg(F.avg(F.col("q.kept").cast("int")).alias("k")).collect()}
    assert share[1] > 0.99 and share[0] < 0.5


URLS = [
    None, "", "no scheme", "https://A.Example.ORG/es/1?q", "http://example.org/en/17#x", "http://xexample.org/es/", "ftp://org",
    "https://sub.example.org/en/2", "https://shop.com/fr/x", "https://com/de/", "https://x.com/DE/", "://y.net/a?b/c", "a://b://c/d",
]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(p), p, v) for v, p in URL_RULES if (host == p.split("/")[0] or host.endswith("." + p.split("/")[0])) and path.startswith("/" + p.split("/", 1)[1])]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    more = [f"https://h{i}.org/fr/{i}" for i in range(80)] + [f"https://h{i}.com/de/{i}" for i in range(80)] + [f"https://h{i}.net/de/{i}" for i in range(9)]
    df = spark.createDataFrame(list(enumerate(URLS + more)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r.url_filter for r in urls.filter_urls(df, URL_RULES).collect()}
    for i, url in enumerate(URLS + more):
        host, path, rule, verdict = plain_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert sum(got[len(URLS) + 160 + i].verdict == "block" for i in range(9)) >= 6
    few = urls.filter_urls(df.limit(5), URL_RULES).collect()
    assert all(r.url_filter.score is None for r in few)
    assert urls.filter_urls(df.filter("false"), URL_RULES).count() == 0


def test_markov_model_sums_to_one():
    model = urls.Markov(3)
    for u in ("abc", "abd", "bcd"):
        model.learn(u)
    seen, context, total = set("abcd\x03"), "\x02ab", 0.0
    for c in [*seen, *(chr(1000 + i) for i in range(urls.ALPHABET - len(seen)))]:
        p = 1.0 / urls.ALPHABET
        for k in range(4):
            row = model.counts.get(context[3 - k :])
            if row is None:
                break
            p = (row.get(c, 0) + len(row) * p) / (model.totals[context[3 - k :]] + len(row))
        total += p
    assert total == pytest.approx(1.0)


def plain_bits(url, counts, order):
    padded, total = "\x02" * order + url + "\x03", 0.0
    for i in range(order, len(padded)):
        p = 1 / urls.ALPHABET
        for k in range(order + 1):
            seen = counts.get(padded[i - k : i], Counter())
            if seen:
                p = (seen[padded[i]] + len(seen) * p) / (seen.total() + len(seen))
        total += math.log2(p)
    return total


def test_url_verdicts_equal_a_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    judged = urls.filter_urls(pages, URL_RULES, order=3, fit_urls=40, least=3).collect()
    draw, held = F.pmod(F.xxhash64("url", F.lit("fit")), F.lit(1 << 20)), F.pmod(F.xxhash64("url", F.lit("held")), F.lit(5)) == 0
    drawn = {r.url: (r.d, r.h) for r in pages.dropna().select("url", draw.alias("d"), held.alias("h")).distinct().collect()}
    said = {u: plain_rule(u)[3] for u in drawn}
    models, unseen = {}, {}
    for side in ("allow", "block"):
        of = [u for u in drawn if said[u] == side]
        chosen = [u for u in of if drawn[u][0] < 40 / len(of) * (1 << 20)]
        counts = defaultdict(Counter)
        for u in chosen:
            padded = "\x02" * 3 + u + "\x03"
            for i in range(3, len(padded) if not drawn[u][1] else 0):
                for k in range(4):
                    counts[padded[i - k : i]][padded[i]] += 1
        models[side], unseen[side] = dict(counts), [u for u in chosen if drawn[u][1]]
    score = lambda u: (plain_bits(u, models["allow"], 3) - plain_bits(u, models["block"], 3)) / (len(u) + 1)
    held_out = {side: [score(u) for u in of] for side, of in unseen.items()}
    quality_of = lambda cut: np.mean([s >= cut for s in held_out["allow"]]) + np.mean([s < cut for s in held_out["block"]])
    cuts = sorted({*held_out["allow"], *held_out["block"]})
    best = max(quality_of(c) for c in [*cuts, cuts[-1] + 1])
    assert quality_of(urls.calibrated(np.array(held_out["allow"]), np.array(held_out["block"]))) == pytest.approx(best)
    cut = urls.calibrated(np.array(held_out["allow"]), np.array(held_out["block"]))
    for r in judged:
        url, f = r.url or "", r.url_filter
        assert f.score == pytest.approx(score(url), abs=1e-9)
        if f.rule is None and abs(f.score - cut) > 1e-9:
            assert f.verdict == ("allow" if f.score >= cut else "block")


def test_few_labelled_urls_can_still_be_learned(spark):
    pages = spark.createDataFrame([(f"http://a.org/{i}",) for i in range(9)] + [(f"http://com/de/{i}",) for i in range(9)], "url string")
    assert urls.filter_urls(pages, URL_RULES).filter("url_filter.score is not null").count() == 0
    assert urls.filter_urls(pages, URL_RULES, least=5).filter("url_filter.score is null").count() == 0


def test_cut_is_calibrated():
    assert urls.calibrated(np.array([2.0, 3.0]), np.array([-1.0, 0.0])) == pytest.approx(1.0)
