"""Named tables for ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Tables of a data folder, one parquet each.
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def read_tables(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in names}


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Make each DataFrame a temporary view under its name."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return sorted(tables)
