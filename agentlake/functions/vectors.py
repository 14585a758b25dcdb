"""Vector expressions over ``ARRAY<FLOAT>`` columns, summed in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Plain dot product, not normalised."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def token_bucket(token: Column, dim: int) -> Column:
    """Stable bucket of a token: the first 32 bits of its MD5."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dim).cast("int")
