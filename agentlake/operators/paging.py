"""Ordered collection per key in pages of bounded size.

Collecting everything a key owns into one value breaks as soon as one key holds
a large share of the table. Here the rows of every key have exact positions in
their order, and page p holds positions p * page_rows + 1 to (p + 1) *
page_rows. No row is dropped; the pages of a key, read in order, are the whole
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.operators.joins import key_of, same, skew_join  # noqa: F401
from agentlake.operators.positions import with_positions

PAGE_ROWS = 10_000


def with_pages(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    page_rows: int = PAGE_ROWS,
    page: str = "page",
    then: Sequence[str] = (),
) -> DataFrame:
    """Add ``page``, from 0: ``page_rows`` rows of a key, in ``seq`` order, share it.

    ``then`` orders rows that share a ``seq``. Rows are placed by
    ``with_positions``, so neither a hot key nor many rows of one ``seq`` meet
    in one task.
    """
    placed = with_positions(df, keys, [seq, *then], "_position")
    return placed.select(*df.columns, F.floor((F.col("_position") - 1) / page_rows).cast("int").alias(page))


def _pages(
    df: DataFrame, keys: Sequence[str], seq: str, value: Column, then: Sequence[str], page_rows: int
) -> tuple[DataFrame, Column]:
    order = {f"_order_{i}": F.col(c) for i, c in enumerate((seq, *then))}
    lean = df.select(*keys, *[c.alias(n) for n, c in order.items()], value.alias("_value"))
    rows = F.sort_array(F.collect_list(F.struct(*order, "_value")))
    return with_pages(lean, keys, "_order_0", page_rows, then=[*order][1:]), rows.getField("_value")


def paged_text(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    text: Column,
    separator: str,
    out: str,
    page_rows: int = PAGE_ROWS,
    then: Sequence[str] = (),
) -> DataFrame:
    """``text`` of each key joined in ``seq`` order: (keys, page, out).

    ``then`` orders the few rows that share one ``seq``, such as the items of
    one document.
    """
    pages, rows = _pages(df, keys, seq, text, then, page_rows)
    return pages.groupBy(*keys, "page").agg(F.array_join(rows, separator).alias(out))


def paged_list(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    out: str,
    page_rows: int = PAGE_ROWS,
    then: Sequence[str] = (),
) -> DataFrame:
    """``value`` of each key as an array in ``seq`` order: (keys, page, out)."""
    pages, rows = _pages(df, keys, seq, value, then, page_rows)
    return pages.groupBy(*keys, "page").agg(rows.alias(out))
