"""Joins and keys that hold when a key is NULL or owns much of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Null-safe equality of ``left`` columns and their ``right`` partners."""
    return reduce(
        lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs.items()]
    )


def skew_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal (also NULL) keys in a form AQE can split when ``left`` has
    a hot key.

    AQE splits a partition only where both sides are shuffled directly below
    the join. A right side aggregated by the same keys would keep the
    aggregate's partitioning and miss that shuffle; null-safe equality gives
    each side one of its own.
    """
    renamed = {k: f"_right_{k}" for k in keys}
    other = right.select(
        *[F.col(k).alias(n) for k, n in renamed.items()], *[c for c in right.columns if c not in renamed]
    )
    joined = left.join(other, same(left, other, renamed), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def key_of(keys: Sequence[str]) -> Column:
    """The key columns as one struct, which groups and joins NULL keys too.

    Unlike null-safe equality it leaves the key one expression, so a join after
    a window or an aggregate on it reuses their partitioning.
    """
    return F.struct(*[F.col(k) for k in keys])
