"""JSON envelopes and display tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.operators.paging import PAGE_ROWS, paged_list, same

# Display headings, in order.
POD_HEADERS = {
    "pod_name": "Pod Name",
    "status": "Status",
    "cpu_request": "CPU Request",
    "memory_request": "Memory Request",
}
SERVICE_HEADERS = {
    "service_name": "Service Name",
    "status": "Status",
    "cluster_ip": "Cluster IP",
    "ports": "Ports",
    "node_port": "Node Port",
    "selector": "Selector",
}


def to_envelope(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    columns: Sequence[str],
    name: str = "results",
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Rows as objects under one JSON key: ``keys, page, envelope``.

    A key with more rows than a page gives several envelopes, each a complete
    JSON document.
    """
    row = F.struct(*[F.col(c) for c in columns])
    pages = paged_list(df, keys, seq, row, "_rows", page_rows)
    return pages.select(*keys, "page", F.to_json(F.struct(F.col("_rows").alias(name))).alias("envelope"))


def envelopes_for(
    requested: DataFrame, envelopes: DataFrame, key: str, noun: str
) -> DataFrame:
    """One answer per requested key; a key without rows gets a message."""
    found = envelopes.withColumnRenamed(key, "_found")
    message = F.to_json(
        F.struct(
            F.concat(F.lit(f"No {noun} found in namespace '"), F.col(key), F.lit("'")).alias("message")
        )
    )
    return requested.join(found, same(requested, found, {key: "_found"}), "left").select(
        *requested.columns,
        F.coalesce("page", F.lit(0)).alias("page"),
        F.coalesce("envelope", message).alias("envelope"),
    )


def task_result(artifacts: dict[str, Column], error: Column) -> Column:
    """Result of a task: ``struct<artifacts map<string,string>, error string>``.

    A failed task has no artifacts.
    """
    pairs = [part for name, value in artifacts.items() for part in (F.lit(name), value.cast("string"))]
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.struct(
        F.when(error.isNull(), F.create_map(*pairs)).otherwise(none).alias("artifacts"),
        error.alias("error"),
    )


def present(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Columns in display order under their display names."""
    return df.select(*[F.col(c).alias(title) for c, title in headers.items()])


def markdown_rows(df: DataFrame, headers: dict[str, str], out: str = "row") -> DataFrame:
    """The same projection as markdown table rows, one text per record."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in headers]
    return df.withColumn(out, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))


def markdown_header(headers: dict[str, str]) -> str:
    titles = list(headers.values())
    return "| " + " | ".join(titles) + " |\n| " + " | ".join("---" for _ in titles) + " |"
