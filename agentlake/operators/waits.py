"""First matching event within an interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.operators.paging import key_of

# The awaited reason and how long to wait, in seconds.
CRASHLOOP = "CrashLoopBackOff"
TIMEOUT_SECONDS = 60


def _bucket(ts: Column, seconds: int) -> Column:
    micros = F.unix_micros(ts)
    width = F.lit(seconds * 1_000_000).cast("long")
    return ((micros - F.pmod(micros, width)) / width).cast("long")


def crashloop_wait(
    status: DataFrame,
    deploys: DataFrame,
    timeout: int = TIMEOUT_SECONDS,
    keys: Sequence[str] = ("namespace", "pod"),
) -> DataFrame:
    """Deploys with ``crashed`` and ``crashed_at``: the first crash loop at or
    after the deploy and less than ``timeout`` seconds later.

    Time is cut into buckets as wide as the timeout. A deploy's answer lies in
    its own bucket, found by a running minimum over deploys and crashes
    together, or is the next bucket's first crash. Deploys and crashes are
    never paired, so a pod that crashes all the time stays linear, and equal
    instants of a pod are merged before the shuffle. ``ts`` must not be NULL.
    """
    key = key_of(keys).alias("_key")

    def moments(df: DataFrame, crash: bool) -> DataFrame:
        return df.select(
            key,
            F.col("ts").cast("timestamp").alias("ts"),
            F.lit(crash).alias("_crash"),
            F.lit(not crash).alias("_deploy"),
        )

    crashes = status.filter(F.col("waiting_reason") == CRASHLOOP)
    instants = (
        moments(crashes, True)
        .unionByName(moments(deploys, False))
        .groupBy("_key", _bucket(F.col("ts"), timeout).alias("_bucket"), "ts")
        .agg(F.max("_crash").alias("_crash"), F.max("_deploy").alias("_deploy"))
    )
    onward = (
        Window.partitionBy("_key", "_bucket")
        .orderBy(F.col("ts").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    crash_time = F.when(F.col("_crash"), F.col("ts"))
    waits = instants.withColumn("_near", F.min(crash_time).over(onward)).filter("_deploy")
    heads = (
        moments(crashes, True)
        .groupBy("_key", (_bucket(F.col("ts"), timeout) - 1).alias("_bucket"))
        .agg(F.min("ts").alias("_next"))
    )
    first = F.coalesce("_near", "_next")
    in_time = F.unix_micros(first) < F.unix_micros("ts") + timeout * 1_000_000
    answers = waits.join(heads, ["_key", "_bucket"], "left").select(
        "_key", "ts", F.when(in_time, first).alias("crashed_at")
    )
    asked = deploys.withColumns({"_key": key, "_at": F.col("ts").cast("timestamp")})
    return asked.join(answers.withColumnRenamed("ts", "_at"), ["_key", "_at"]).select(
        *deploys.columns, F.col("crashed_at").isNotNull().alias("crashed"), "crashed_at"
    )
