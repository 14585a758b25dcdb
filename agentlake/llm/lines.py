"""Line deduplication over levelled sorted runs of line hashes.

Batches arrive in rising document order. The keys of a batch are reduced to one
row each, merge-joined with the runs, and those that no run holds become a new
run, sorted and bucketed by hash. Runs of a level are compacted into one of the
next level, so few runs have to be joined. DataFrame functions only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.llm.text import SPACES, ascii_lower, row_of
from agentlake.operators.paging import key_of, skew_join
from agentlake.session import scratch_path, written

#: Shortest key that counts, in code points.
SHORTEST = 10
#: Runs of one level that are merged into a run of the next, and batches of a
#: table that is deduplicated in one call.
FANOUT = 2
BATCHES = 4
_KEY = ["h", "g"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


@dataclass
class LineStore:
    """Runs of line hashes below the shared folder.

    A run has a row (h, g, owner) per key, its owner being the smallest id of
    its batch; 96 bits of hash stand for the key. Ids of a batch must not be
    below those of earlier batches.
    """

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[str]] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(t).filter("NOT seen").select(*_KEY, "owner") for level in self.levels for t in level]

    def _sorted_run(self, rows: DataFrame) -> str:
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.write.format("parquet")
            .option("path", scratch_path(self.spark, name))
            .bucketBy(parts, *_KEY)
            .sortBy(*_KEY)
            .saveAsTable(name)
        )
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Take a batch of rows (doc_id, h, g) and return the keys that cost
        lines: (h, g, owner) of those that an earlier batch or several
        documents of this one hold."""
        keys = lines.groupBy(*_KEY).agg(
            F.min("doc_id").alias("own"),
            (F.min("doc_id") < F.max("doc_id")).alias("shared"),
            F.max(F.col("doc_id").isNull()).alias("nameless"),
        )
        hits = []
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.select(*_KEY, F.col("owner").alias(f"_o{i}"), F.lit(True).alias(f"_s{i}")), _KEY, "left")
            hits.append(i)
        seen = F.lit(False)
        for i in hits:
            seen = seen | F.col(f"_s{i}").isNotNull()
        judged = keys.select(
            *_KEY,
            F.coalesce(*[F.col(f"_o{i}") for i in hits], "own").alias("owner"),
            seen.alias("seen"),
            (F.coalesce("shared", F.lit(False)) | F.col("nameless")).alias("shared"),
        )
        name = self._sorted_run(judged)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        costly = self.spark.table(name).filter("(seen OR shared) AND owner IS NOT NULL").select(*_KEY, "owner")
        return costly

    def compact(self) -> None:
        """Merge full levels. Earlier results of ``add`` must have been read."""
        at = 0
        while at < len(self.levels):
            level = self.levels[at]
            if len(level) >= self.fanout:
                rows = self.spark.table(level[0]).filter("NOT seen")
                for name in level[1:]:
                    rows = rows.unionByName(self.spark.table(name).filter("NOT seen"))
                merged = self._sorted_run(rows.repartition(*_KEY))
                if at + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[at + 1].append(merged)
                self._forget(level)
                self.levels[at] = []
            at += 1

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        for level in self.levels:
            self._forget(level)
        self.levels = []


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    out: str = "lines",
) -> DataFrame:
    """Add ``out``: a struct (n_lines, n_dropped, kept) per row.

    A text is split at newlines; NULL and "" are one empty line. A line's key
    is the line without outer white space, A-Z in lower case. A key of at least
    ``shortest`` code points that several documents hold keeps its lines in the
    smallest id only, all of them there. Rows that share an id are one
    document. A NULL id comes after all others and never owns a key. A column
    already named ``out`` is replaced. ``docs`` is read twice: once for the
    hashes and once for the result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        row_of(docs).alias("_row"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).withColumn("_th", F.xxhash64("_text"))
    cuts = rows.agg(
        F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000).alias("cuts")
    ).first()["cuts"] if batches > 1 else None
    cuts = sorted(set(cuts or []))
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + F.when(F.col("doc_id").isNull() | (F.col("doc_id") > F.lit(cut)), 1).otherwise(0)
    path = scratch_path(spark, "lines")
    exploded = rows.select("doc_id", "_th", batch.alias("batch"), F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line"))
    keyed = exploded.withColumn("_k", line_key(F.col("line"))).filter(F.char_length("_k") >= shortest)
    hashed = keyed.select("doc_id", "_th", "pos", F.xxhash64("_k").alias("h"), F.hash("_k").alias("g"), "batch")
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)

    store, drops = LineStore(spark, fanout), None
    for b in range(len(cuts) + 1):
        mine = lines.filter(F.col("batch") == b)
        costly = store.add(mine)
        lost = skew_join(mine, costly, _KEY).filter(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("owner")))
        lost, _, _ = written(lost.select("doc_id", "_th", "pos"), "dropped")
        drops = lost if drops is None else drops.unionByName(lost)
        store.compact()
    store.close()

    gone = (
        drops.groupBy(key_of(["doc_id", "_th"]).alias("_id"))
        .agg(F.collect_set("pos").alias("_gone"))
    )
    own = rows.withColumn("_id", key_of(["doc_id", "_th"])).drop("doc_id", "_th")
    both = own.join(gone, "_id", "left")
    parts = F.split("_text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.array_size(parts) - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    )
    n_lines = F.char_length("_text") - F.char_length(F.replace(F.col("_text"), F.lit("\n"), F.lit(""))) + 1
    result = F.struct(
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.array_size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
    # In a step of its own: inside a lambda, a column's new name would hide ``_text``.
    done = both.select("_row", result.alias("_result"))
    columns = [F.col("_row")[c].alias(c) for c in docs.columns if c != out]
    return done.select(*columns, F.col("_result").alias(out))
