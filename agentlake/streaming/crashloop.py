"""Waiting for a crash loop after a deploy, as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.operators.waits import CRASHLOOP, TIMEOUT_SECONDS, crashloop_wait
from agentlake.session import scratch_path, written
from agentlake.streaming.folded import run_batches


def stream_crashloop(
    status: DataFrame,
    deploys: DataFrame,
    timeout: int = TIMEOUT_SECONDS,
    delay: str = "1 second",
    path: str | None = None,
) -> DataFrame:
    """True at a deploy's first crash loop within ``timeout``, false after it.

    Both inputs are streams of ``namespace, pod, ts`` (``status`` also has
    ``waiting_reason``); all that is available is processed. The watermark is the
    latest instant so far less ``delay``, which is how late rows may come. A false
    answer is given once the watermark has passed the timeout, in whole
    milliseconds, and stays. Rows older than the watermark still take part: a
    deploy meets the crashes still known, a crash the deploys still open. Rows
    without an instant take none. Output ``namespace, pod, ts, crashed,
    crashed_at``, a row per deploy.

    A batch is answered by ``crashloop_wait`` together with what earlier ones left:
    deploys without an answer and crashes a later deploy may still meet. Both are
    a table, so a pod that deploys or crashes all the time is never held by one
    task. ``path`` keeps answers and what is left; a later run goes on from them.
    """
    spark = deploys.sparkSession
    path = path or scratch_path(spark, "crashloop")
    names = [deploys.schema["namespace"], deploys.schema["pod"]]
    states = T.StructType([*names, T.StructField("ts", T.TimestampType()), T.StructField("deploy", T.BooleanType())])
    rows = T.StructType(
        [*names, T.StructField("ts", T.TimestampType()), T.StructField("crashed", T.BooleanType()), T.StructField("crashed_at", T.TimestampType())]
    )
    spark.createDataFrame([], rows).write.mode("overwrite").parquet(f"{path}/rows/batch=-1")

    def lean(df: DataFrame, deploy: bool) -> DataFrame:
        at = F.col("ts").cast("timestamp")
        return df.select("namespace", "pod", at.alias("ts"), F.lit(deploy).alias("deploy")).filter(at.isNotNull())

    def each(batch: DataFrame, number: int) -> None:
        left, mark = spark.createDataFrame([], states), None
        if number > 0:
            left = spark.read.schema(states).parquet(f"{path}/states/batch={number - 1}")
            mark = spark.read.schema("mark long").parquet(f"{path}/marks/batch={number - 1}").first()["mark"]
        moments, _, _ = written(left.unionByName(batch), "crashloop-moments")
        latest = moments.agg(F.unix_micros(F.max("ts") - F.expr(f"interval {delay}"))).first()[0]
        mark = max((m for m in (mark, latest) if m is not None), default=None)

        def past(micros: Column) -> Column:
            return F.lit(False) if mark is None else micros <= F.lit(mark)

        crashes = moments.filter("not deploy").withColumn("waiting_reason", F.lit(CRASHLOOP))
        judged, _, _ = written(crashloop_wait(crashes, moments.filter("deploy"), timeout), "crashloop-answers")
        # Ends of the wait and the watermark are compared in whole milliseconds.
        end = (F.unix_millis("ts") + timeout * 1000 + 1) * 1000
        judged = judged.withColumn("settled", F.col("crashed") | past(end))
        judged.filter("settled").select(*rows.names).write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        # A deploy that comes in time is no older than the watermark.
        recent = moments.filter("not deploy").filter(~past(F.unix_micros("ts") + 1)).distinct()
        kept = judged.filter("not settled").select(*states.names).unionByName(recent.select(*states.names))
        kept.write.mode("overwrite").parquet(f"{path}/states/batch={number}")
        marks = spark.createDataFrame([(mark,)], "mark long").coalesce(1)
        marks.write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    both = lean(status.filter(F.col("waiting_reason") == CRASHLOOP), False).unionByName(lean(deploys, True))
    run_batches(both, path, each)
    return spark.read.schema(rows).parquet(f"{path}/rows").drop("batch")
