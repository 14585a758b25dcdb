"""Folders of JSON documents, read whole or as files arrive, with rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.functions.jsontext import strict_json
from agentlake.session import scratch_path
from agentlake.sources.cards import with_card_uri
from agentlake.sources.items import BAD_JSON

#: Why a file holds no document.
NOT_TEXT = "not UTF-8"
JSON_FILES = "*.[jJ][sS][oO][nN]"


def read_documents(spark: SparkSession, path: str, keys: str = "", glob: str = JSON_FILES) -> DataFrame:
    """One row per file: ``keys, file_name, modified, size, text, doc, reject``.

    ``keys`` declares partition columns that subfolders spell out, such as
    ``namespace string`` for ``path/namespace=prod/pods.json``; a filter on them
    leaves out whole subfolders before any file is opened, and one on
    ``modified`` or ``size`` leaves out files. ``doc`` is a VARIANT. A file that is
    no UTF-8 or not one JSON document keeps its row with a NULL ``doc`` and the
    reason in ``reject``; where no subfolder spells out a key it is NULL. Spark
    passes over files without a byte. Files are whole,
    so one must fit the memory of a task (2 GB at most).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    spelled = T.StructType.fromDDL(keys) if keys else T.StructType()
    if all(key.name in files.columns for key in spelled):
        return _documents(spark.read, path, keys, glob)
    absent = [F.lit(None).cast(key.dataType).alias(key.name) for key in spelled]
    return _parsed(files.select(*files.columns[:4], *absent))


def stream_documents(
    spark: SparkSession, path: str, keys: str = "", glob: str = JSON_FILES, files_per_batch: int = 10_000
) -> DataFrame:
    """The same rows as a stream: each file once, when it has appeared.

    The checkpoint of the query that reads it remembers the files it has seen.
    """
    return _documents(spark.readStream.option("maxFilesPerTrigger", files_per_batch), path, keys, glob)


def _documents(reader, path: str, keys: str, glob: str) -> DataFrame:
    # Columns of Spark's reader of whole files.
    whole = "path string, modificationTime timestamp, length long, content binary"
    files = (
        reader.format("binaryFile")
        .schema(f"{whole}, {keys}" if keys else whole)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return _parsed(files)


def _parsed(files: DataFrame) -> DataFrame:
    own = files.columns[4:]
    text = F.col("content").cast("string")
    named = files.select(
        *own,
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
        F.when(F.is_valid_utf8(text), text).alias("text"),
    )
    parsed = named.withColumn("doc", strict_json(F.col("text")))
    reason = F.when(F.col("text").isNull(), NOT_TEXT).when(F.col("doc").isNull(), BAD_JSON)
    return parsed.withColumn("reject", reason)


def cards_of(documents: DataFrame) -> DataFrame:
    """Cards among documents: ``card_uri, agent_card, card``, as ``read_cards``."""
    usable = with_card_uri(documents.filter(F.col("reject").isNull()))
    return usable.select("card_uri", F.col("text").alias("agent_card"), F.col("doc").alias("card"))


def items_of(documents: DataFrame, *keys: str) -> DataFrame:
    """Items of documents ``{"items": [...]}``: ``keys, pos, item, reject``.

    A rejected file leaves one row with its reason and neither position nor
    item. A document without a list under ``items``, or with an empty one,
    leaves none.
    """

    def row(pos: Column, item: Column, reject: Column) -> Column:
        return F.struct(
            pos.cast("int").alias("pos"), item.cast("variant").alias("item"), reject.cast("string").alias("reject")
        )

    none = F.lit(None)
    listed = F.try_variant_get("doc", "$.items", "array<variant>")
    rows = F.when(F.col("reject").isNotNull(), F.array(row(none, none, F.col("reject")))).otherwise(
        F.transform(listed, lambda item, pos: row(pos, item, none))
    )
    return documents.select(*keys, F.explode(rows).alias("_row")).select(*keys, "_row.*")


def append_new(stream: DataFrame, path: str | None = None, *by: str) -> DataFrame:
    """Append what a stream of documents has to a table; the whole table.

    Processes all that is available and ends. ``path`` holds the table and the
    stream's checkpoint: a later run reads only files that have come since, and
    one that was cut off goes on without repeated or lost rows. VARIANT columns
    are kept as they are; ``by`` names columns whose values get folders.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "documents")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    query = (writer.partitionBy(*by) if by else writer).trigger(availableNow=True).start(f"{path}/rows")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows").select(*stream.columns)
