"""Language identification: known words first, then shorter and shorter pieces.

A word that training has seen scores by its log frequency in each language. An
unseen word falls back to its character n-grams, the longest length of which
any is known.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.llm.text import SPACES, as_bytes, ascii_lower

#: Bounds of the fitted model: labelled documents per language, and known words
#: and n-grams of each length per language.
FIT_DOCS = 4_000
WORDS = 20_000
GRAMS = 5_000
LENGTHS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
#: Parts in which the pieces of a language are ranked before they meet.
SALTS = 32
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode category L; numerals are none."""
    return any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    docs_per_language: int = FIT_DOCS,
    words: int = WORDS,
    grams: int = GRAMS,
) -> dict:
    """A model of bounded size from labelled rows.

    At most about ``docs_per_language`` rows of each language are read, chosen
    by a hash of their key; every label is learned. Counting is done by Spark;
    what reaches the driver is the ``words`` most frequent words and the
    ``grams`` most frequent n-grams of each length of each language.
    """
    rows = labelled.filter(F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    names = sorted(r["lang"] for r in found)
    share = {r["lang"]: r["n"] for r in found}
    if not names:
        return {"names": [], "prior": np.zeros(0), "tables": {}, "floor": {}}
    rate = F.create_map(*[F.lit(x) for name in names for x in (name, docs_per_language / share[name])])[F.col("lang")]
    chosen = rows.filter(F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1 << 20)) < rate * (1 << 20))
    tokens = chosen.select("lang", F.explode(F.split(ascii_lower(F.coalesce("text", F.lit(""))), f"[{SPACES}]+")).alias("word"))
    counted = tokens.filter("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    bare = F.regexp_replace("word", r"^[^\p{L}]+|[^\p{L}]+$", "")
    counted = counted.select("lang", bare.alias("word"), "n").filter("word <> ''")
    pieces = [
        counted.select("lang", F.lit(0).alias("size"), F.col("word").alias("piece"), "n"),
        counted.select(
            "lang", F.explode(F.array(*[F.lit(k) for k in LENGTHS])).alias("size"), F.concat(F.lit(" "), "word", F.lit(" ")).alias("padded"), "n"
        ).filter(F.char_length("padded") >= F.col("size")).select(
            "lang",
            "size",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.char_length("padded") - F.col("size") + 1),
                    lambda i: F.substring(F.col("padded"), i, F.col("size")),
                )
            ).alias("piece"),
            "n",
        ),
    ]
    table = pieces[0].unionByName(pieces[1]).groupBy("lang", "size", "piece").agg(F.sum("n").alias("n"))
    # First the best of each part of a language's pieces, then the best of those.
    salted = table.withColumn("salt", F.pmod(F.xxhash64("piece"), F.lit(SALTS)))
    most = F.when(F.col("size") == 0, words).otherwise(grams)
    top = salted
    for part in (["lang", "size", "salt"], ["lang", "size"]):
        best = Window.partitionBy(*part).orderBy(F.desc("n"), "piece")
        top = top.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= most).drop("_r")
    at = {name: i for i, name in enumerate(names)}
    counts: dict[int, dict[str, np.ndarray]] = {k: {} for k in (0, *LENGTHS)}
    for r in top.select("lang", "size", "piece", "n").toLocalIterator():
        row = counts[r["size"]].setdefault(r["piece"], np.zeros(len(names)))
        row[at[r["lang"]]] = r["n"]
    tables: dict[int, dict[str, int]] = {}
    matrix = []
    for size, own in counts.items():
        if not own:
            tables[size] = {}
            continue
        block = np.array(list(own.values()))
        total = block.sum(axis=0, keepdims=True)
        tables[size] = {piece: len(matrix) + i for i, piece in enumerate(own)}
        matrix.extend(np.log((block + 0.5) / (total + 0.5 * len(own))).astype(np.float32))
    prior = np.log(np.array([share[n] for n in names], dtype=float) / sum(share[n] for n in names))
    return {"names": names, "prior": prior, "tables": tables, "matrix": np.array(matrix)}


class Scorer:
    """Log frequencies of the words of a text, summed per language."""

    def __init__(self, model: dict, most: int = 200_000):
        self.model, self.most = model, most
        self.known: dict[str, int] = model["tables"].get(0, {})
        self.unseen: dict[str, np.ndarray | None] = {}

    def pieces(self, word: str) -> np.ndarray | None:
        """Mean over the word's known n-grams of the greatest length with any."""
        if word in self.unseen:
            return self.unseen[word]
        padded, found = f" {word} ", None
        for size in LENGTHS:
            table = self.model["tables"][size]
            rows = [table[g] for i in range(len(padded) - size + 1) if (g := padded[i : i + size]) in table]
            if rows:
                found = self.model["matrix"][rows].mean(axis=0)
                break
        if len(self.unseen) >= self.most:
            self.unseen.clear()
        self.unseen[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        names = self.model["names"]
        if not text or not names or not has_letter(text):
            return UNKNOWN, 0.0
        counts = Counter(text.encode().lower().split())
        rows, times, total = [], [], self.model["prior"].copy()
        for raw, n in counts.items():
            word = raw.decode("utf-8", "replace")
            if not word.isalpha():
                word = strip_outer(word)
                if not word:
                    continue
            at = self.known.get(word)
            if at is not None:
                rows.append(at)
                times.append(n)
            elif (vector := self.pieces(word)) is not None:
                total = total + n * vector
        if rows:
            total = total + np.array(times, dtype=float) @ self.model["matrix"][rows]
        best = int(total.argmax())
        return names[best], float(1.0 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def strip_outer(word: str) -> str:
    """The word without what is no letter at either end."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


def predicted(model: dict, spark) -> "callable":
    """A column function text -> struct (lang_pred, score).

    The text is NULL, or has no letter, or nothing was learned: ``und``, 0. A
    tie goes to the language first in code-point order.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            got = [scorer.predict(bytes(t).decode("utf-8", "replace")) for t in texts]
            yield pd.DataFrame(got, columns=["lang_pred", "score"])

    return lambda text: predict(as_bytes(text))


def identify(docs: DataFrame, model: dict, text: str = "text", out: str = "language") -> DataFrame:
    """Add ``out``: a struct (lang_pred, score); a column of that name is replaced.

    Whole texts are scored where they are read, without a shuffle.
    """
    apply = predicted(model, docs.sparkSession)
    return docs.withColumn(out, apply(F.col(text)))
