"""Optimal length buckets: boundaries by dynamic programming over the global
histogram of lengths, then token-budget batches inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.llm.text import word_count
from agentlake.operators.positions import with_positions
from agentlake.session import written

#: Buckets, and padded words of a batch.
BUCKETS = 16
BUDGET = 65_536
#: Lengths up to ``EXACT`` have bins of their own. Above, a power of two is cut
#: into ``EXACT / 2`` bins, so a histogram over any lengths stays bounded and a
#: boundary is at most 1 / 1024 from the best.
EXACT = 2_048


def histogram_bin(length: Column, exact: int = EXACT) -> Column:
    """First length of the bin that a length is in."""
    shift = F.greatest(F.length(F.bin(length)) - F.length(F.bin(F.lit(exact - 1))), F.lit(0))
    width = F.pow(F.lit(2.0), shift)
    return (F.floor(length / width) * width).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``lengths`` rise; bin ``i`` holds ``counts[i]`` rows of ``sums[i]`` words in
    all, none longer than ``lengths[i]``. With f(k, j) the least padding of the
    first j bins in k buckets, f(k, j) = min over i of f(k-1, i) + lengths[j] *
    (rows of i..j) - (words of i..j). The terms in i are lines in lengths[j],
    so their lower hull gives every minimum in one pass over the bins.
    """
    n = len(lengths)
    rows = [0, *np.cumsum(counts).tolist()]
    words = [0, *np.cumsum(sums).tolist()]
    sizes = [int(v) for v in lengths]
    before = [0, *[None] * n]
    back: list[list[int]] = []
    for _ in range(min(buckets, n)):
        hull: list[tuple[int, int, int]] = []  # slope, height, bin
        head, now, came = 0, [None] * (n + 1), [0] * (n + 1)
        now[0] = 0
        for j in range(1, n + 1):
            if before[j - 1] is not None:
                line = (-rows[j - 1], before[j - 1] + words[j - 1], j - 1)
                while len(hull) - head >= 2:
                    (a, b, _), (c, d, _) = hull[-2], hull[-1]
                    if (line[1] - b) * (a - c) <= (d - b) * (a - line[0]):
                        hull.pop()
                    else:
                        break
                hull.append(line)
            x = sizes[j - 1]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                head += 1
            slope, height, at = hull[head]
            now[j], came[j] = slope * x + height + x * rows[j] - words[j], at
        back.append(came)
        before = now
    ends, j = [], n
    for came in reversed(back):
        if j == 0:
            break
        ends.append(sizes[j - 1])
        j = came[j]
    return ends[::-1]


def length_buckets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    length: Column | None = None,
    exact: int | None = EXACT,
) -> DataFrame:
    """Batches of documents of like length.

    Returns one row per row of ``docs``: (doc_id, n_words, bucket, pad_to,
    batch, slot, padding). ``length`` defaults to the number of words. Bucket
    bounds minimise all padding. Inside a bucket rows lie in the order of a hash
    of their id and length, ``floor(budget / pad_to)`` rows to a batch, one at
    least: a row longer than the budget is a batch of its own. A NULL or empty
    text has length 0 and pads nothing. No rows give no rows. The histogram
    that reaches the driver has a bounded number of bins whatever the lengths;
    with ``exact=None`` every length has its own, and bounds are the best at any
    length, at one row of four numbers per distinct length.
    """
    size = word_count(F.col(text)) if length is None else length.cast("long")
    lean, _, _ = written(docs.select(F.col(doc_id).alias("doc_id"), size.alias("n_words")), "lengths")
    bins = (
        lean.groupBy((F.col("n_words") if exact is None else histogram_bin(F.col("n_words"), exact)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("n_words").alias("words"), F.max("n_words").alias("top"))
        .orderBy("bin")
        .collect()
    )
    tops = np.array([b["top"] for b in bins], dtype=np.int64)
    ends = best_boundaries(
        tops, np.array([b["rows"] for b in bins]), np.array([b["words"] for b in bins]), buckets
    ) or [0]
    bucket = F.lit(len(ends) - 1)
    for i in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("n_words") <= ends[i], i).otherwise(bucket)
    pad_to = F.element_at(F.array(*[F.lit(e).cast("long") for e in ends]), F.col("bucket") + 1)
    dealt = with_positions(
        lean.withColumn("bucket", bucket), ["bucket"], [F.xxhash64("doc_id", "n_words"), "doc_id"], "_at"
    ).withColumn("pad_to", pad_to)
    per_batch = F.greatest(F.floor(F.lit(budget) / F.greatest("pad_to", F.lit(1))), F.lit(1))
    return dealt.select(
        "doc_id",
        "n_words",
        "bucket",
        "pad_to",
        F.floor((F.col("_at") - 1) / per_batch).cast("long").alias("batch"),
        ((F.col("_at") - 1) % per_batch).cast("int").alias("slot"),
        (F.col("pad_to") - F.col("n_words")).alias("padding"),
    )
