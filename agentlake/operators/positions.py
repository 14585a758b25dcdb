"""Exact position of every row within its key, however many rows a key has.

A window over a hot key would sort all its rows in one task. Here the rows are
range-partitioned by (key, order), so a hot key spreads over many partitions;
counts per partition and key are small and give each partition its start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.operators.joins import key_of, skew_join
from agentlake.session import written

#: Rows of a key that one task sorts. Where no key has more, a window numbers
#: them; the positions are the same.
WINDOW_ROWS = 100_000
#: ``monotonically_increasing_id`` keeps the partition above these bits.
_ROW_BITS = 33


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    position: str = "pos",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``position`` (from 1): the rank of the row among the rows of its key.

    Rows with equal keys and order columns are told apart by an own number, so
    even a table of one repeated row spreads. NULL keys form a key of their
    own. The frame is written to the shared folder once, so keep it lean; the
    order then is fixed whatever is lost later.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if keys and (largest or 0) <= window_rows:
        inside = Window.partitionBy(*keys).orderBy(*by, F.monotonically_increasing_id())
        return df.withColumn(position, F.row_number().over(inside).cast("long"))
    names = [f"_position_order_{i}" for i in range(len(by))]
    lean = df.withColumns({"_position_tie": F.monotonically_increasing_id(), **dict(zip(names, by))})
    sorting = [*[F.col(k) for k in keys], *[F.col(n) for n in names], F.col("_position_tie")]
    ranged = (
        lean.repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_position_tie", *names)
    )
    rows, _, _ = written(ranged, "positions")
    part = F.shiftright("_row", _ROW_BITS)
    rows = rows.withColumn("_part", part)
    spans = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # One row for each key and partition that it reaches, never one for each row.
    earlier = (
        Window.partitionBy(key_of(keys) if keys else F.lit(0))
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts, _, _ = written(
        spans.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), "position-starts"
    )
    joined = skew_join(rows, starts, [*keys, "_part"])
    return joined.select(
        *df.columns, (F.col("_start") + F.col("_row") - F.col("_first") + 1).alias(position)
    )
