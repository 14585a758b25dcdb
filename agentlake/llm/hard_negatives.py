"""Hard negatives by exact scores from a residue number system.

Vectors become whole numbers. Blocks of anchors meet blocks of rows: the matrices
modulo a few small primes are multiplied in float32, where no sum reaches 2**24
and so all are exact, and Chinese remaindering gives back the signed scores. The
scores of an anchor, sorted, hold every positive's negatives in one window.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.llm.text import packed, unpacked
from agentlake.session import written

#: Whole steps of a component, positives of an anchor, negatives of a positive,
#: and their least score in hundredths of the positive's.
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST = 80
#: Rows and anchors of a block, anchors scored at a time, pairs of blocks per
#: task at most once there are many.
ITEM_ROWS = 8_192
ANCHOR_ROWS = 4_096
TOGETHER = 256
MOST_TASKS = 20_000

#: Sums of float32 products are exact below this.
EXACT = 1 << 24
NOTHING = np.iinfo(np.int64).min


def _primes(n: int, below: int = 256) -> list[int]:
    """The ``n`` largest primes under ``below``."""
    found = [p for p in range(below - 1, 2, -1) if all(p % d for d in range(2, isqrt(p) + 1))]
    return found[:n]


#: Their product lies below 2**63, and above twice any score that is let in.
MODULI = _primes(8)


def _largest(dim: int) -> int:
    """Components up to this keep 100 times every score below 2**62."""
    return isqrt((1 << 62) // (100 * max(dim, 1)))


def _residues(values: np.ndarray, prime: int) -> np.ndarray:
    """Centred residues, as float32."""
    rest = values % prime
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def _product(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """left times right transposed, modulo ``prime``; both are centred residues."""
    width = EXACT // (prime // 2) ** 2
    total = np.zeros((len(left), len(right)), np.int64)
    for a in range(0, left.shape[1], width):
        total += np.rint(left[:, a : a + width] @ right[:, a : a + width].T).astype(np.int64)
    return total % prime


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two int64 matrices, exactly.

    As many primes are used as the largest components ask for. Mixed-radix
    digits put the residues together; values in the upper half are negative.
    """
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    bound = left.shape[1] * int(np.abs(left).max()) * int(np.abs(right).max())
    scores, whole = np.zeros((len(left), len(right)), np.int64), 1
    for prime in MODULI:
        rest = _product(_residues(left, prime), _residues(right, prime), prime)
        digit = (rest - scores % prime) * pow(whole, -1, prime) % prime
        scores += whole * digit
        whole *= prime
        if whole > 2 * bound:
            break
    else:
        raise OverflowError("components are too large for exact scores")
    return np.where(scores > whole // 2, scores - whole, scores)


_BLOB = "dim int, block int, n int, ids binary, labels binary, numbers binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (dim, block) of a stream sorted by them and by id."""
    names = [c.split()[0] for c in _BLOB.split(", ")]
    now, held = None, []

    def blob() -> pa.RecordBatch:
        ids, labels, numbers = (np.concatenate(x) for x in zip(*held))
        row = (now[0], now[1], len(ids), packed(ids), packed(labels), packed(numbers))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        dims, blocks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "block"))
        heads = np.flatnonzero((np.diff(dims, prepend=-1) != 0) | (np.diff(blocks, prepend=-1) != 0))
        for a, b in zip(heads, np.append(heads[1:], len(dims))):
            key = (int(dims[a]), int(blocks[a]))
            if key != now and held:
                yield blob()
                held = []
            now = key
            own = batch.slice(a, b - a)
            held.append(tuple(
                x.to_numpy(zero_copy_only=False).astype(np.int64)
                for x in (own.column("id"), own.column("label"), own.column("numbers").flatten())
            ))
    if held:
        yield blob()


def _blocked(rows: DataFrame, sizes: DataFrame, blocks: str, total: int, name: str) -> DataFrame:
    """Rows packed into ``sizes[blocks]`` blocks per number of components."""
    placed = rows.join(sizes.select("dim", blocks), "dim").withColumn("block", F.pmod(F.monotonically_increasing_id(), F.col(blocks)).cast("int"))
    dealt = placed.repartitionById(total, F.pmod(F.col("block") + F.hash("dim"), F.lit(total)).cast("int"))
    sorted_rows = dealt.sortWithinPartitions("dim", "block", "id").select("dim", "block", "id", "label", "numbers")
    return written(sorted_rows.mapInArrow(_pack, _BLOB), name)[0]


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[dict, dict, list]]:
    """(anchors, rows, positives) of each pair of blocks in a sorted stream.

    An anchor block, its positives and the block of rows come one after the
    other; one pair is held at a time.
    """
    anchors, positives = None, None
    for batch in batches:
        for row in batch.to_dict("records"):
            if row["kind"] == 0:
                anchors, positives = _opened(row), None
            elif row["kind"] == 1:
                positives = row["positives"]
            else:
                yield anchors, _opened(row), positives


def _opened(row: dict) -> dict:
    ids, labels, numbers = (unpacked(row[c], np.int64) for c in ("ids", "labels", "numbers"))
    return {
        "dim": int(row["dim"]), "anchor_block": int(row["anchor_block"]),
        "ids": ids, "labels": labels, "numbers": numbers.reshape(len(ids), int(row["dim"])),
    }


def _tiles(anchors: dict, rows: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first anchor, scores, whether labels agree) for some anchors at a time."""
    for a in range(0, len(anchors["ids"]), TOGETHER):
        scores = exact_scores(anchors["numbers"][a : a + TOGETHER], rows["numbers"])
        yield a, scores, anchors["labels"][a : a + TOGETHER, None] == rows["labels"][None, :]


_POSITIVE = "dim int, anchor_block int, at int, anchor_id long, positive_id long, positive_score long"


def _positives(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Each anchor's first rows of its label out of one block."""
    for anchors, rows, _ in _pairs(batches):
        for a, scores, same in _tiles(anchors, rows):
            own = anchors["ids"][a : a + TOGETHER]
            kept = np.where(same & (own[:, None] != rows["ids"][None, :]), scores, NOTHING)
            # Rows are sorted by id, so a stable sort leaves ties in that order.
            order = np.argsort(-np.maximum(kept, NOTHING + 1), axis=1, kind="stable")[:, :most]
            best = np.take_along_axis(kept, order, axis=1)
            at, nth = np.nonzero(best > NOTHING)
            yield pd.DataFrame(
                {
                    "dim": anchors["dim"], "anchor_block": anchors["anchor_block"], "at": a + at, "anchor_id": own[at],
                    "positive_id": rows["ids"][order[at, nth]], "positive_score": best[at, nth],
                }
            )


_NEGATIVE = (
    "dim int, anchor_block int, at int, positive_rank int, anchor_id long, positive_id long, positive_score long, "
    "negative_id long, negative_score long"
)


def _negatives(batches: Iterator[pd.DataFrame], most: int, least: int) -> Iterator[pd.DataFrame]:
    """Each positive's first rows of another label inside its window of scores."""
    for anchors, rows, positives in _pairs(batches):
        if positives is None:
            continue
        asked = pd.DataFrame([p if isinstance(p, dict) else p.asDict() for p in positives]).sort_values(["at", "positive_rank"])
        for a, scores, same in _tiles(anchors, rows):
            own = asked[(asked["at"] >= a) & (asked["at"] < a + TOGETHER)]
            if not len(own):
                continue
            kept = np.where(same, NOTHING + 1, scores)
            order = np.argsort(-kept, axis=1, kind="stable")
            falling = -np.take_along_axis(kept, order, axis=1)
            line, bound = own["at"].to_numpy() - a, own["positive_score"].to_numpy()
            first = np.array([np.searchsorted(falling[i], -b) for i, b in zip(line, bound)], np.int64)
            place = first[:, None] + np.arange(most)
            inside = place < falling.shape[1]
            place = np.minimum(place, falling.shape[1] - 1)
            found = -falling[line[:, None], place]
            inside &= found > NOTHING + 1
            inside[inside] = (100 * found[inside]) >= least * np.repeat(bound, most).reshape(found.shape)[inside]
            i, nth = np.nonzero(inside)
            named = own.iloc[i]
            yield pd.DataFrame(
                {
                    "dim": anchors["dim"], "anchor_block": anchors["anchor_block"],
                    "at": named["at"].to_numpy(), "positive_rank": named["positive_rank"].to_numpy(),
                    "anchor_id": anchors["ids"][named["at"].to_numpy()],
                    "positive_id": named["positive_id"].to_numpy(), "positive_score": named["positive_score"].to_numpy(),
                    "negative_id": rows["ids"][order[line[i], place[i, nth]]], "negative_score": found[i, nth],
                }
            )


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    items: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    item_rows: int = ITEM_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """The first negatives of each anchor's first positives.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). A component x counts as floor(scale * x); scores are whole
    inner products. An anchor's positives are its first ``positives`` other rows
    of its label, the highest score first, ties by the smaller key; a positive's
    negatives are the first rows of other labels that score at most as high and
    at least ``least`` hundredths of it. Positives without such rows give none.

    Rows with a NULL key, label, vector or component, or one that is not finite,
    take no part, nor do those with components beyond ``_largest``, whose scores
    might not fit a long. Vectors meet those with as many components. Repeated
    rows each count and repeated anchors are each answered, but no row that has
    an anchor's key is its positive. Other columns are not read.

    Every anchor meets every row, in blocks: one pair of blocks is held at a
    time, and only the best rows of a pair leave it.
    """
    spark = items.sparkSession
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    dims = F.array_size(value)
    # A little below ``_largest``, as it is reckoned in double precision.
    largest = F.sqrt(F.lit(float(1 << 62)) / (F.lit(100.0) * F.greatest(dims, F.lit(1)))) * 0.999
    small = F.forall(value, lambda x: F.abs(x * scale) < largest - 1)
    rows = items.filter(
        F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(small, F.lit(False))
    ).select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.transform(value, lambda x: F.floor(x * scale).cast("long")).alias("numbers"),
        dims.alias("dim"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    n_blocks = lambda n, most: F.ceil(n / F.lit(most)).cast("int")
    sizes, _, some = written(
        rows.groupBy("dim")
        .agg(n_blocks(F.count(F.lit(1)), item_rows).alias("row_blocks"), n_blocks(F.count_if("anchor"), anchor_rows).alias("anchor_blocks"))
        .filter("anchor_blocks > 0"),
        "negative-sizes",
    )
    if not some:
        return spark.createDataFrame([], _RESULT)
    sums = sizes.agg(F.sum("row_blocks"), F.sum("anchor_blocks"), F.sum(F.col("row_blocks").cast("long") * F.col("anchor_blocks"))).first()
    row_blocks, anchor_blocks, tasks = (min(int(s), MOST_TASKS) for s in sums)
    blocks = _blocked(rows, sizes, "row_blocks", row_blocks, "negative-rows")
    asking = _blocked(rows.filter("anchor"), sizes, "anchor_blocks", anchor_blocks, "negative-anchors")

    def met(found: DataFrame | None = None) -> DataFrame:
        """Every anchor block beside every block of rows, sorted pair by pair."""
        each_row = F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("row_block")
        each_anchor = F.explode(F.sequence(F.lit(0), F.col("anchor_blocks") - 1)).alias("anchor_block")
        left = asking.withColumnRenamed("block", "anchor_block").join(sizes, "dim").select("*", each_row).withColumn("kind", F.lit(0))
        right = blocks.withColumnRenamed("block", "row_block").join(sizes, "dim").select("*", each_anchor).withColumn("kind", F.lit(2))
        both = left.unionByName(right)
        if found is not None:
            both = both.unionByName(found.join(sizes, "dim").select("*", each_row).withColumn("kind", F.lit(1)), allowMissingColumns=True)
        number = F.col("row_block").cast("long") * F.col("anchor_blocks") + F.col("anchor_block") + F.hash("dim")
        dealt = both.repartitionById(tasks, F.pmod(number, F.lit(tasks)).cast("int"))
        return dealt.sortWithinPartitions("dim", "row_block", "anchor_block", "kind").drop("row_blocks", "anchor_blocks")

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _positives(batches, positives)

    def window(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _negatives(batches, negatives, least)

    nearest = Window.partitionBy("dim", "anchor_block", "at").orderBy(F.desc("positive_score"), "positive_id")
    best = met().mapInPandas(first, _POSITIVE).withColumn("positive_rank", F.row_number().over(nearest)).filter(F.col("positive_rank") <= positives)
    # A block's positives are at most ``anchor_rows`` times ``positives``.
    of_block = best.groupBy("dim", "anchor_block").agg(F.collect_list(F.struct("at", "positive_rank", "positive_id", "positive_score")).alias("positives"))
    found, _, _ = written(of_block, "negative-positives")
    hardest = Window.partitionBy("dim", "anchor_block", "at", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    hits = met(found).mapInPandas(window, _NEGATIVE).withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= negatives)
    return hits.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
