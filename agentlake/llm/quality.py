"""Quality rules: base counts of a text, and how far its histograms of character
classes and common words lie from those of a language."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agentlake.llm.text import WordHashes, as_bytes, joined
from agentlake.session import written

#: Common words kept per language; words, and share of all words, that a language
#: needs for a reference of its own. Languages below share one reference. The
#: share keeps the references few: at most 1 / LEAST_SHARE languages reach it.
COMMON = 200
REFERENCE_WORDS, LEAST_SHARE = 2_000, 0.001
#: Texts shorter than these are not judged by the histogram.
LEAST_CHARS, LEAST_WORDS = 200, 60
#: Largest Jensen-Shannon distance that passes. A short text strays further by
#: chance alone, by about 1 / sqrt(size), so that much more is allowed.
CHAR_LIMIT, CHAR_SLACK = 0.24, 1.0
WORD_LIMIT, WORD_SLACK = 0.40, 2.5
FEWEST_WORDS, MOST_REPEATED = 50, 50
POOLED = ""

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "newline", "point", "symbol", "other ascii", "non-ascii", "inner")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other ascii"), np.uint8)
    table[0x80:0xC0] = CLASSES.index("inner")
    table[0xC0:] = CLASSES.index("non-ascii")
    for name, characters in (
        ("lower", bytes(range(97, 123))),
        ("upper", bytes(range(65, 91))),
        ("digit", b"0123456789"),
        ("space", b" \t\x0b\x0c\r"),
        ("newline", b"\n"),
        ("point", b".,;:!?'\"()-"),
        ("symbol", SYMBOLS),
    ):
        table[list(characters)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()
JUDGED = len(CLASSES) - 1


def class_counts(raw: bytes) -> np.ndarray:
    """Characters of UTF-8 bytes by class; the last entry counts inner bytes."""
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES))


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of rows of counts to a distribution."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = np.broadcast_to(reference, p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def base_counts(raw: bytes, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    classes = class_counts(raw)
    tokens = raw.split()
    separators = int(classes[3] + classes[4])
    chars = len(raw) - int(classes[-1]) - separators
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = 0
    if len(tokens) > 3:
        h = hashes.of(tokens)
        windows = joined(joined(h[:-2], h[1:-1]), h[2:])
        _, at, n = np.unique(windows, return_inverse=True, return_counts=True)
        twice = n[at] > 1
        if twice.any():
            covered = np.zeros(len(tokens), bool)
            for k in range(3):
                covered[k : k + len(twice)] |= twice
            repeated = int(covered.sum())
    return len(tokens), chars, int(classes[6]), len(lines) - len(set(lines)), repeated


def references(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    common: int = COMMON,
    least_words: int = REFERENCE_WORDS,
    least_share: float = LEAST_SHARE,
) -> list[dict]:
    """Class shares and common-word shares per language, over all documents.

    Languages with fewer than ``least_words`` words or less than ``least_share``
    of all words share one reference with the documents of NULL language: their
    words are added up whole before the common ones are chosen, of equally
    common ones the first in byte order. A shared reference below
    ``least_words`` is left out. Repeated rows count as often as they stand.
    No rows give no reference. What reaches the driver is ``common`` words of
    at most ``1 / least_share`` languages, whatever the number of labels.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        tokens: dict[str, Counter] = defaultdict(Counter)

        def flushed() -> pd.DataFrame:
            rows = [(k, 1, w, n) for k, c in tokens.items() for w, n in c.items()]
            rows += [(k, 0, str(i).encode(), int(n)) for k, c in classes.items() for i, n in enumerate(c) if n]
            tokens.clear()
            classes.clear()
            return pd.DataFrame(rows, columns=["lang", "kind", "item", "n"])

        held = 0
        for batch in batches:
            for name, raw in zip(batch["lang"], batch["text"]):
                held -= len(tokens[name])
                classes[name] += class_counts(raw)
                tokens[name].update(bytes(raw).lower().split())
                held += len(tokens[name])
                if held > 300_000 or len(classes) > 10_000:
                    held = 0
                    yield flushed()
        yield flushed()

    rows = docs.select(F.coalesce(F.col(lang), F.lit(POOLED)).alias("lang"), as_bytes(F.col(text)).alias("text"))
    sums = (
        rows.mapInPandas(counted, "lang string, kind int, item binary, n long")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    counts, _, _ = written(sums, "word-counts")
    totals = counts.filter("kind = 1").groupBy("lang").agg(F.sum("n").alias("words"))
    everything = totals.agg(F.sum("words")).first()[0] or 0
    large = totals.filter((F.col("words") >= least_words) & (F.col("words") >= least_share * everything))
    own, _, _ = written(large.select(F.col("lang").alias("own")), "languages")
    pooled = (
        counts.join(own, F.col("lang") == F.col("own"), "left")
        .groupBy(F.coalesce("own", F.lit(POOLED)).alias("lang"), "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    top = pooled.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= common).drop("_r")
    whole = pooled.filter("kind = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = top.unionByName(whole.select("lang", F.lit(2).alias("kind"), F.lit(b"").alias("item"), "n"))
    grouped: dict[str, dict] = {}
    for r in ranked.collect():
        g = grouped.setdefault(r["lang"], {"classes": np.zeros(JUDGED), "words": {}, "n": 0})
        if r["kind"] == 0:
            if int(r["item"]) < JUDGED:
                g["classes"][int(r["item"])] = r["n"]
        elif r["kind"] == 1:
            g["words"][bytes(r["item"])] = r["n"]
        else:
            g["n"] = r["n"]
    made = []
    for name in sorted(grouped):
        g = grouped[name]
        if g["n"] < least_words:
            continue
        listed = sorted(g["words"])
        shares = np.array([*[g["words"][w] for w in listed], max(g["n"] - sum(g["words"].values()), 0)], float)
        made.append({"lang": name, "classes": g["classes"] / g["classes"].sum(), "words": listed, "shares": shares / shares.sum()})
    return made


class CommonWords:
    """Shares of common words of all references, by word.

    A text is compared through the common words it holds, so memory follows
    those and the number of references, not their product.
    """

    def __init__(self, refs: list[dict]):
        self.column = {w: i for i, w in enumerate(sorted({w for r in refs for w in r["words"]}))}
        at = [(self.column[w], i, s) for i, r in enumerate(refs) for w, s in zip(r["words"], r["shares"])]
        at.sort()
        self.start = np.searchsorted([c for c, _, _ in at], np.arange(len(self.column) + 1))
        self.reference = np.array([i for _, i, _ in at], np.int64)
        self.share = np.array([s for _, _, s in at], float)
        self.rest = np.array([r["shares"][-1] for r in refs], float)

    def distances(self, words: list[bytes]) -> np.ndarray:
        """Jensen-Shannon distance of one text's words to every reference.

        A common word that the text lacks adds its share, as does a word of the
        text for a reference without it, which counts among the rest there.
        """
        column, n = self.column, len(self.rest)
        found = np.array([c for w in words if (c := column.get(w)) is not None], np.int64)
        held, times = np.unique(found, return_counts=True)
        sizes = self.start[held + 1] - self.start[held]
        entry = np.repeat(self.start[held] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        to, q = self.reference[entry], self.share[entry]
        p = np.repeat(times, sizes) / max(len(words), 1)
        terms = np.bincount(to, _divergence(p, q), n) + 1 - self.rest - np.bincount(to, q, n)
        listed = np.bincount(to, np.repeat(times, sizes), n)
        terms += _divergence((len(words) - listed) / max(len(words), 1), self.rest)
        return np.sqrt(np.clip(terms / 2, 0.0, 1.0))


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """p log2(p / m) + q log2(q / m) with m midway."""
    with np.errstate(divide="ignore", invalid="ignore"):
        m = (p + q) / 2
        return np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)


def judged(refs: list[dict], spark):
    """A column function text -> struct of the base counts, distances, verdict.

    A text is compared with every reference and the nearest counts, as its
    language may be unknown or wrong. A NULL text counts as empty and fails the
    base rules; without any reference the base rules decide alone.
    """
    shared = spark.sparkContext.broadcast(refs)

    @F.pandas_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "char_distance double, word_distance double, base_failed boolean, kept boolean"
    )
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        refs, hashes = shared.value, WordHashes(300_000)
        common = CommonWords(refs)
        for texts in batches:
            raws = [bytes(t) for t in texts]
            base = np.array([base_counts(r, hashes) for r in raws], np.int64).reshape(-1, 5)
            classes = np.array([class_counts(r)[:JUDGED] for r in raws], float).reshape(-1, JUDGED)
            far_char = far_word = np.zeros(len(raws))
            if refs:
                far_char = np.min([distance(classes, r["classes"]) for r in refs], axis=0)
                far_word = np.array([common.distances(raw.lower().split()).min() for raw in raws], float)
            chars, n = classes.sum(axis=1), base[:, 0]
            failed = (n < FEWEST_WORDS) | (100 * base[:, 4] > MOST_REPEATED * n)
            off = (chars >= LEAST_CHARS) & (far_char > CHAR_LIMIT + CHAR_SLACK / np.sqrt(np.maximum(chars, 1)))
            off |= (n >= LEAST_WORDS) & (far_word > WORD_LIMIT + WORD_SLACK / np.sqrt(np.maximum(n, 1)))
            yield pd.DataFrame(
                {
                    **{c: base[:, i] for i, c in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))},
                    "char_distance": far_char,
                    "word_distance": far_word,
                    "base_failed": failed,
                    "kept": ~failed & ~off,
                }
            )

    return lambda text: judge(as_bytes(text))


def judge_quality(docs: DataFrame, refs: list[dict], text: str = "text", out: str = "quality") -> DataFrame:
    """Add ``out``: a struct (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, char_distance, word_distance, base_failed, kept).

    Every row is judged by itself, so repeated rows have equal results. No
    shuffle; a column already named ``out`` is replaced.
    """
    apply = judged(refs, docs.sparkSession)
    return docs.withColumn(out, apply(F.col(text)))
