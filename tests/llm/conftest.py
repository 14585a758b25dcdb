from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts() -> list[str | None]:
    """NULL, empty, blank, tiny, repeated, huge and near-equal texts."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "é", "Ünï", "x\u00a0y"]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    texts: list[str | None] = [None, "", " \n\t ", "one", "One two", "ONE two", "a b c", "A b\tc"]
    for b in base:
        parts = b.split()
        texts += [b, b.upper().lower(), b + " tail", " ".join(parts[:60] + ["new"] + parts[60:])]
    line = "A common line of many words\n"
    texts += [line + b[:200] + "\n  " + line.upper() + "short\nshort" for b in base]
    texts += [" ".join(base * 40), "#" * 500, "\n".join(["same line here"] * 30)]
    return texts


@pytest.fixture(scope="session")
def odd_rows():
    langs, sources = ["en", "fr", None], ["s2", "s1", None, "é", "S"]
    texts = odd_texts()
    return [(i, t, langs[i % 3], sources[i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """With columns named like those the operators use inside."""
    docs = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    clash = {c: F.lit(c) for c in ("_row", "size", "h", "pos", "token", "_text", "_size", "_id", "leader", "batch", "key", "own")}
    return docs.withColumns(clash)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
