"""Embeddings that are kept: only new or changed texts are embedded.

A vector is stored under the hash of its text, in numbered segments. A segment
holds the vectors of the texts that were new at that refresh and the hashes
that nothing uses any more. Equal texts share a vector.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.operators.joins import skew_join
from agentlake.operators.vectors import DIM, embed
from agentlake.session import written

_VECTORS = "hash string, embedding array<float>, segment int"
_GONE = "hash string, segment int"


def content_hash(text: Column) -> Column:
    """SHA-256 of the text; NULL counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _segments(spark: SparkSession, path: str, schema: str, before: int | None) -> DataFrame:
    if before == 0:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).parquet(path)
    return stored if before is None else stored.filter(F.col("segment") < before)


def stored_vectors(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The vectors in use after all segments, or those below ``before``: ``hash, embedding``."""
    vectors = _segments(spark, f"{path}/vectors", _VECTORS, before)
    gone = _segments(spark, f"{path}/gone", _GONE, before).groupBy("hash").agg(F.max("segment").alias("_until"))
    later = (F.col("hash") == F.col("_gone")) & (F.col("segment") <= F.col("_until"))
    return vectors.join(gone.withColumnRenamed("hash", "_gone"), later, "left_anti").select("hash", "embedding")


def refresh(
    df: DataFrame,
    path: str,
    segment: int,
    text: str,
    fn: Callable[[pd.Series], pd.Series] | None = None,
    dim: int = DIM,
) -> None:
    """Bring the vectors at ``path`` up to the texts of ``df``, as segment ``segment``.

    Segments are numbered from 0 upwards by the caller. A repeated call reads only
    lower ones and replaces its own, so a refresh that was cut off is run again.
    Hashes are compared first; the texts read after that are the new ones only,
    each embedded once by ``fn`` (``embed``'s default without one). Hashes that
    ``df`` no longer has leave.
    """
    spark = df.sparkSession
    texts = df.select(content_hash(F.col(text)).alias("hash"), F.coalesce(text, F.lit("")).alias("_text"))
    present, _, _ = written(texts.select("hash").distinct(), "content-hashes")
    known = stored_vectors(spark, path, segment).select("hash")
    gone, _, _ = written(known.join(present, "hash", "left_anti"), "gone-hashes")
    fresh, _, _ = written(present.join(known, "hash", "left_anti"), "new-hashes")
    once = skew_join(texts, fresh, ["hash"], "left_semi").groupBy("hash").agg(F.any_value("_text").alias("_text"))
    # Written first: the vectors of this segment must not be listed while it is replaced.
    new, _, _ = written(embed(once, "_text", fn=fn, dim=dim).select("hash", "embedding"), "new-vectors")
    new.write.mode("overwrite").parquet(f"{path}/vectors/segment={segment}")
    gone.write.mode("overwrite").parquet(f"{path}/gone/segment={segment}")


def with_stored(df: DataFrame, path: str, text: str, out: str = "embedding") -> DataFrame:
    """Add the stored vector of each row's text, NULL where it has none."""
    vectors = stored_vectors(df.sparkSession, path).select(F.col("hash").alias("_hash"), F.col("embedding").alias("_stored"))
    joined = skew_join(df.withColumn("_hash", content_hash(F.col(text))), vectors, ["_hash"], "left")
    return joined.select(*[c for c in df.columns if c != out], F.col("_stored").alias(out))


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the vectors in use to ``target`` as one segment, number 0."""
    kept = stored_vectors(spark, path)
    kept.write.parquet(f"{target}/vectors/segment=0")
    kept.select("hash").limit(0).write.parquet(f"{target}/gone/segment=0")
