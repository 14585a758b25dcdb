"""Agent card documents."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.functions.jsontext import strict_json

logger = logging.getLogger(__name__)

# Fixed value: scheme and path of a card's key.
CARD_URI_PREFIX = "resource://agent_cards/"


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """One row per readable JSON file directly inside ``path``.

    Columns ``card_uri, agent_card`` (the text) and ``card`` (VARIANT). Files
    that are not UTF-8 or not one JSON document are skipped; a missing folder
    gives no rows.
    """
    empty = spark.createDataFrame([], "card_uri string, agent_card string, card variant")
    try:
        files = (
            spark.read.option("pathGlobFilter", "*.[jJ][sS][oO][nN]")
            .text(path, wholetext=True)
            .select("value", F.col("_metadata.file_name").alias("file_name"))
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.error("card folder not found: %s", path)
        return empty
    readable = files.filter(F.is_valid_utf8("value")).withColumn("card", strict_json(F.col("value")))
    return with_card_uri(readable.filter(F.col("card").isNotNull())).select(
        "card_uri", F.col("value").alias("agent_card"), "card"
    )


def with_card_uri(df: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Add ``card_uri``: the prefix and the file name without its last suffix."""
    name = F.url_decode(F.replace(F.col(file_name), F.lit("+"), F.lit("%2B")))
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return df.withColumn("card_uri", F.concat(F.lit(CARD_URI_PREFIX), stem))
