"""Container logs as numbered lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: ``<namespace>/<pod>/<container>.log``
LOG_PATH = r"([^/]+)/([^/]+)/([^/]+)\.log$"


def read_logs(spark: SparkSession, path: str, layout: str = LOG_PATH) -> DataFrame:
    """Lines of log files: ``namespace, pod, container, line_no, line``.

    Files are read in splits, so one large log is spread over many tasks. A
    line's number is its place within the split plus the lines of the splits
    before it; the counts per split are all that is shuffled per file.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_row"),
            F.col("value").alias("line"),
        )
    )
    within = Window.partitionBy("_file", "_split").orderBy("_row")
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("_file", "_split")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    numbered = lines.withColumn("_place", F.row_number().over(within)).join(splits, ["_file", "_split"])
    file_path = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    return numbered.select(
        F.regexp_extract(file_path, layout, 1).alias("namespace"),
        F.regexp_extract(file_path, layout, 2).alias("pod"),
        F.regexp_extract(file_path, layout, 3).alias("container"),
        (F.col("_before") + F.col("_place")).cast("long").alias("line_no"),
        "line",
    )


def split_logs(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Whole log texts to lines: ``keys, line_no, line``; a final newline ends
    the last line and adds none."""
    body = F.regexp_replace(F.col(text), r"\n\z", "")
    lines = F.split(F.when(F.col(text) != "", body), r"\r?\n")
    return df.select(*keys, F.posexplode(lines).alias("_pos", "line")).select(
        *keys, (F.col("_pos") + 1).cast("long").alias("line_no"), "line"
    )
