"""A corpus from raw documents to padded batches.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.llm import buckets, jaccard, lines, mixing, quality
from agentlake.llm.queries import settings
from agentlake.llm.text import row_of
from agentlake.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near a language's histograms."""
    settings(spark)
    judged = quality.judge_quality(docs, quality.references(docs), out="_stage_quality")
    return judged.filter("_stage_quality.kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; every row stays."""
    deduped = lines.dedup_lines(docs, out="_stage_lines")
    changed = {"text": F.when(F.col("text").isNotNull(), F.col("_stage_lines.kept"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(F.col("_stage_lines.kept")).cast(docs.schema["n_chars"].dataType)
    return deduped.withColumns(changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the least id.

    Documents without words stay. Rows with a NULL id stay unless another row
    has their words. Of rows that share an id and a text, one stays.
    """
    settings(spark)
    found, _ = jaccard.jaccard_groups(docs)
    alone = (F.col("n_shingles") == 0) | F.col("component_id").isNull()
    kept, _, _ = written(
        found.filter(alone | F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.count(F.lit(1)).alias("_times"), F.max(F.col("n_shingles") > 0).alias("_worded")),
        "kept",
    )
    rows = docs.select(row_of(docs).alias("_row"), F.col("doc_id").cast("long").alias("_key"))
    joined = rows.join(kept, F.col("_key").eqNullSafe(F.col("_id")))
    once = joined.filter("_times = 1").select("_row.*")
    several = joined.filter("_times > 1").select("_row.*")
    return once.unionByName(several.dropDuplicates(["doc_id", "text"]))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate takes it."""
    return mixing.repeated(mixing.mix_sources(docs, out="_stage_mix"), "_stage_mix").select(*docs.columns)


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch, slot and padding of every row of the mix."""
    return buckets.length_buckets(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("length buckets", length_buckets),
]

#: The histograms' distances are not stated in SQL; the tests hold run() against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table of the shared folder."""
    docs = settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _, _ = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
