"""Log records of several lines, and templates of lines that differ in words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.operators.joins import key_of, skew_join
from agentlake.operators.logs import severity, template
from agentlake.operators.positions import with_positions
from agentlake.session import written

#: Lines of a key that one task scans in order.
BLOCK_ROWS = 100_000
#: Words of a line that select its leaf, and different words a place keeps.
DEPTH = 4
MAX_CHILDREN = 100
ANY = "<*>"

_KEYS = ("namespace", "pod", "container")
_TRACE, _LINK, _CAUSE, _PLAIN = "trace", "link", "cause", "plain"
_LINKS = r"^(During handling of the above exception|The above exception was the direct cause)"


def _kind(line: Column) -> Column:
    """What a line that is neither indented nor empty is; NULL for the others."""
    text = F.coalesce(line, F.lit(""))
    return (
        F.when(text.rlike(r"^(\s|$)"), F.lit(None))
        .when(text.startswith("Traceback"), F.lit(_TRACE))
        .when(text.rlike(_LINKS), F.lit(_LINK))
        .when(text.rlike(r"^(Caused by|Suppressed):"), F.lit(_CAUSE))
        .otherwise(F.lit(_PLAIN))
    )


def with_records(
    lines: DataFrame,
    keys: Sequence[str] = _KEYS,
    seq: str = "line_no",
    line: str = "line",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``record``: the ``seq`` of the first line of the record a line belongs to.

    Indented and empty (or NULL) lines go on with the record before them, as do
    causes and the sentences between chained tracebacks. A traceback also takes
    the line after its frames, which names the exception, and the traceback
    after such a sentence. Every other line begins a record, and so does the
    first line of a key.

    Lines are scanned inside blocks of ``block_rows`` lines of a key. What a
    block hands to the next is one row, so a hot key spreads over its blocks.
    ``seq`` must be unique within a key; a column named ``record`` is replaced.
    """
    inside = Window.partitionBy("_key", "_block").orderBy("_place")
    past = inside.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    marked, _, _ = written(
        with_positions(lines, keys, [seq], "_place")
        .withColumns(
            {"_key": key_of(keys), "_block": F.floor((F.col("_place") - 1) / block_rows), "_kind": _kind(F.col(line))}
        )
        .withColumns(
            {
                "_after_inner": F.lag(F.col("_kind").isNull()).over(inside),
                "_before": F.last("_kind", ignorenulls=True).over(past),
            }
        ),
        "log-lines",
    )
    handed = (
        marked.groupBy("_key", "_block")
        .agg(
            F.max_by(F.col("_kind").isNull(), "_place").alias("_inner"),
            F.max_by("_kind", F.when(F.col("_kind").isNotNull(), F.col("_place"))).alias("_last"),
        )
        .select(
            "_key",
            "_block",
            F.last("_inner").over(earlier).alias("_handed_inner"),
            F.last("_last", ignorenulls=True).over(earlier).alias("_handed_kind"),
        )
    )
    kind, before = F.col("_kind"), F.coalesce("_before", "_handed_kind", F.lit(""))
    closes = (before == _TRACE) & F.coalesce("_after_inner", "_handed_inner", F.lit(False))
    begins = (
        (F.col("_place") == 1)
        | ((kind == _PLAIN) & ~closes)
        | ((kind == _TRACE) & (before != _LINK))
    )
    headed = (
        marked.join(handed, ["_key", "_block"])
        .withColumn("_head", F.when(begins, F.col(seq)))
        .withColumn("_within", F.max("_head").over(inside))
    )
    heads = (
        headed.groupBy("_key", "_block")
        .agg(F.max("_head").alias("_latest"))
        .select("_key", "_block", F.max("_latest").over(earlier).alias("_open"))
    )
    return headed.join(heads, ["_key", "_block"]).select(
        *[c for c in lines.columns if c != "record"], F.coalesce("_within", "_open").alias("record")
    )


def log_records(
    lines: DataFrame,
    keys: Sequence[str] = _KEYS,
    seq: str = "line_no",
    line: str = "line",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per record: ``keys, first_line, last_line, lines, frames, severity, head, cause``.

    ``frames`` counts indented lines. ``cause`` is the last line that is not
    indented, so the exception of a traceback and the innermost cause of a
    chain. Rows are added up before the shuffle; a record of any length is one
    row, and ``with_records`` with ``paged_text`` gives its text.
    """
    outer = F.when(_kind(F.col(line)).isNotNull(), F.col(seq))
    frame = _kind(F.col(line)).isNull() & (F.trim(F.coalesce(line, F.lit(""))) != "")
    grouped = (
        with_records(lines.select(*keys, seq, line), keys, seq, line, block_rows)
        .groupBy(*keys, F.col("record").alias("first_line"))
        .agg(
            F.max(seq).alias("last_line"),
            F.count(F.lit(1)).alias("lines"),
            F.count_if(frame).alias("frames"),
            F.min_by(line, seq).alias("head"),
            F.max_by(line, outer).alias("cause"),
        )
    )
    level = F.when(F.col("frames") > 0, F.lit("stack_trace")).otherwise(severity(F.coalesce("head", F.lit(""))))
    return grouped.select(*keys, "first_line", "last_line", "lines", "frames", level.alias("severity"), "head", "cause")


def log_templates(
    lines: DataFrame,
    keys: Sequence[str] = (),
    line: str = "line",
    depth: int = DEPTH,
    max_children: int = MAX_CHILDREN,
) -> DataFrame:
    """Templates of lines that differ in words: ``keys, template, lines, variants``.

    Lines lose ids and numbers first. Lines of equally many words form a tree by
    their first ``depth`` words; a node with more than ``max_children`` different
    words below takes them as one branch ``<*>``, so its subtrees merge before
    the next level is judged. In a leaf, a later place with more different words
    becomes ``<*>`` too. Words are joined by one blank; NULL is the empty line.

    Counts add up, so the result does not depend on how lines are spread.
    ``variants`` counts the lines without ids and numbers that a template stands
    for. Only these, not the lines, are kept between levels.
    """
    words = F.split(template(F.coalesce(line, F.lit(""))), r"\s+")
    table, _, _ = written(
        lines.groupBy(*keys, words.alias("_words"))
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(*keys, F.size("_words").alias("_size"), "_words", "lines", F.lit(1).cast("long").alias("variants")),
        "templates",
    )
    for level in range(depth):
        node = [*keys, "_size", "_prefix"]
        placed = table.withColumn("_prefix", F.slice("_words", 1, level))
        below = placed.filter(F.col("_size") > level).select(*node, F.get("_words", F.lit(level)).alias("_word"))
        crowded, _, any_crowded = written(_crowded(below, node, max_children), "crowded-nodes")
        if any_crowded:
            merged = F.transform(
                "_words", lambda w, i: F.when((i == level) & F.col("_merge"), F.lit(ANY)).otherwise(w)
            )
            table = _merged(skew_join(placed, crowded.withColumn("_merge", F.lit(True)), node, "left"), keys, merged)
    leaf = [*keys, "_size", "_prefix"]
    placed = table.withColumn("_prefix", F.slice("_words", 1, depth))
    places = placed.select(*leaf, F.posexplode("_words").alias("_place", "_word")).filter(F.col("_place") >= depth)
    crowded, _, any_crowded = written(
        _crowded(places, [*leaf, "_place"], max_children).groupBy(*leaf).agg(F.collect_list("_place").alias("_merge")),
        "crowded-places",
    )
    if any_crowded:
        merged = F.transform(
            "_words", lambda w, i: F.when(F.array_contains("_merge", i), F.lit(ANY)).otherwise(w)
        )
        table = _merged(skew_join(placed, crowded, leaf, "left"), keys, merged)
    return table.select(*keys, F.array_join("_words", " ").alias("template"), "lines", "variants")


def _crowded(words: DataFrame, node: Sequence[str], most: int) -> DataFrame:
    """Nodes with more than ``most`` different words; counted from distinct rows."""
    distinct = words.distinct().groupBy(*node).agg(F.count(F.lit(1)).alias("_children"))
    return distinct.filter(F.col("_children") > most).drop("_children")


def _merged(joined: DataFrame, keys: Sequence[str], words: Column) -> DataFrame:
    summed = (
        joined.select(*keys, "_size", words.alias("_words"), "lines", "variants")
        .groupBy(*keys, "_size", "_words")
        .agg(F.sum("lines").alias("lines"), F.sum("variants").alias("variants"))
    )
    return written(summed, "templates")[0]
