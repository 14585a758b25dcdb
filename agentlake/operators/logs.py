"""Log lines: severities, repeated patterns, known causes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Severities by the first pattern found in a line.
SEVERITIES = (
    ("stack_trace", r"^\s+at \S+|^Traceback|^\s*File \""),
    ("error", r"(?i)\b(error|fatal|exception|panic)\b"),
    ("warning", r"(?i)\bwarn(ing)?\b"),
)

# What a template leaves out, in this order.
TEMPLATE_PARTS = (
    (r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "<id>"),
    (r"\b0x[0-9a-fA-F]+\b", "<id>"),
    (r"[0-9]+(\.[0-9]+)*", "<n>"),
)


class Rule(NamedTuple):
    """A cause recognised in a log or event line."""

    category: str
    pattern: str
    remediation: str


# The named causes and what is advised for each.
RULES = (
    Rule("ImagePullBackOff", r"(?i)ImagePullBackOff|ErrImagePull", "Correct image name in deployment"),
    Rule("OOMKilled", r"(?i)OOMKilled|out of memory", "Increase memory limits in resource.limits"),
    Rule("ApplicationError", r"(?i)\b(error|exception)\b", "Check application code for exceptions"),
)


def severity(line: Column) -> Column:
    level = F.lit("info")
    for name, pattern in reversed(SEVERITIES):
        level = F.when(line.rlike(pattern), F.lit(name)).otherwise(level)
    return level


def template(line: Column) -> Column:
    """The line with ids and numbers replaced, so repeats become equal."""
    for pattern, mark in TEMPLATE_PARTS:
        line = F.regexp_replace(line, pattern, mark)
    return F.trim(line)


def log_patterns(
    lines: DataFrame,
    keys: Sequence[str] = ("namespace", "pod"),
    seq: str = "line_no",
    top: int | None = None,
) -> DataFrame:
    """How often each template occurs: ``keys, severity, template, lines, first_line, last_line``.

    Counting is partial before the shuffle, so a pod that writes most of the
    log costs no more than its distinct templates. ``top`` keeps each key's
    most frequent templates and adds ``rank``.
    """
    counted = (
        lines.select(
            *keys,
            severity(F.col("line")).alias("severity"),
            template(F.col("line")).alias("template"),
            F.col(seq).alias("_seq"),
        )
        .groupBy(*keys, "severity", "template")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("_seq").alias("first_line"),
            F.max("_seq").alias("last_line"),
        )
    )
    if top is None:
        return counted
    order = Window.partitionBy(*keys).orderBy(F.col("lines").desc(), "severity", "template")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def classify_findings(lines: DataFrame, rules: Sequence[Rule] = RULES, line: str = "line") -> DataFrame:
    """Every rule a line meets: the line's columns, ``category, remediation``.

    The rules are a short fixed list, so they are evaluated as one expression
    in the scan of the lines; nothing is joined.
    """
    hits = [
        F.when(
            F.col(line).rlike(rule.pattern),
            F.struct(
                F.lit(rule.category).alias("category"), F.lit(rule.remediation).alias("remediation")
            ),
        )
        for rule in rules
    ]
    return lines.select(
        *lines.columns, F.explode(F.array_compact(F.array(*hits))).alias("_hit")
    ).select(*lines.columns, "_hit.category", "_hit.remediation")


def pod_findings(
    lines: DataFrame, keys: Sequence[str] = ("namespace", "pod"), rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One text per pod: each category met, its line count and its remediation.

    At most one entry per rule, so the text is bounded by the rule list.
    """
    counted = (
        classify_findings(lines.select(*keys, "line"), rules)
        .groupBy(*keys, "category", "remediation")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    entry = F.concat(
        F.col("category"), F.lit(" ("), F.col("lines").cast("string"), F.lit("): "), F.col("remediation")
    )
    return counted.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(entry)), "; ").alias("findings")
    )
