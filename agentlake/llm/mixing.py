"""Mixing sources to target weights by repeating documents.

Tokens per source are summed, a target per source is derived from its weight,
and every document is emitted floor(rate) times plus one more time with
probability equal to the fraction, decided by a seeded hash of its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.llm.text import row_of, word_count
from agentlake.operators.paging import skew_join
from agentlake.operators.positions import with_positions
from agentlake.session import written

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Size of the mix, and of a source's largest target, in sizes of what is given.
TOTAL, MOST = 1.5, 2.0
SEED = "mix-1"


def chance(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key's text and the seed only."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.substring(F.md5(text.cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("long") / F.lit(2.0**48)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, most: float = MOST
) -> DataFrame:
    """Targets from rows (source, size): (source, source_size, target).

    ``total`` times all sizes is shared by weight. A source above ``most`` times
    its own size stops there and its excess is shared among the others by
    weight, until none is above. Each round is one sum over the table of
    sources; only two numbers reach the driver. NULL is a source, the last.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = with_positions(per_source, [], [F.col("source").isNull(), "source"], "_at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_at") - 1) % len(weights) + 1).cast("int"))
    table, _, _ = written(ranked.select("source", "source_size", weight.alias("_w")), "sources")
    level, capped = 0.0, F.lit(most) * F.col("source_size") <= F.col("_w") * F.lit(0.0)
    while True:
        got = table.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0.0)).alias("weight"),
        ).first()
        if not got["all"] or not got["weight"]:
            break
        risen = (total * got["all"] - most * got["stopped"]) / got["weight"]
        if risen <= level:
            break
        level = risen
        capped = F.lit(most) * F.col("source_size") <= F.col("_w") * F.lit(level)
    target = F.when(capped, F.lit(most) * F.col("source_size")).otherwise(F.col("_w") * F.lit(level))
    return table.select("source", "source_size", target.cast("double").alias("target"))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    total: float = TOTAL,
    most: float = MOST,
    seed: str = SEED,
    out: str = "mix",
) -> DataFrame:
    """Add ``out``: a struct (size, source_size, target, copies) per row.

    ``size`` is the number of words. ``copies`` is how often the mix takes the
    row; ``repeated`` turns it into rows. Rows that share an id share their
    chance, so repeated rows are taken alike; a NULL id counts as empty text, a
    NULL text has size 0, and a source of size 0 has target 0 and no copies. A
    column already named ``out`` is replaced. The joined table has a row per
    source; Catalyst broadcasts it while its known size is small, else AQE can
    split a hot source.
    """
    rows = docs.select(
        row_of(docs).alias("_row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("_size"),
    )
    targets, _, _ = written(
        source_targets(rows.select("source", F.col("_size").alias("size")), weights, total, most), "targets"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("_rate")
    extra = F.when(chance(F.col("_row")[doc_id], seed) < F.col("_rate") - whole, 1).otherwise(0)
    mix = F.struct(
        F.col("_size").alias("size"), "source_size", "target", (whole + extra).cast("int").alias("copies")
    )
    joined = skew_join(rows, targets, ["source"]).withColumn("_rate", rate)
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c != out]
    return joined.select(*kept, mix.alias(out))


def repeated(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """Every row as often as the mix takes it, without ``out``."""
    times = F.expr(f"explode(array_repeat(0, `{out}`.copies))").alias("_time")
    return mixed.select(F.struct(*[F.col(f"`{c}`") for c in mixed.columns if c != out]).alias("_row"), times).select(
        "_row.*"
    )
