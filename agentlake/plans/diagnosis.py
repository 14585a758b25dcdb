"""Diagnosis of pods from their details, events and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.operators.cluster import NO_EVENTS, POD_KEY, format_events
from agentlake.operators.logs import pod_findings
from agentlake.operators.paging import PAGE_ROWS, paged_text
from agentlake.sources.sinks import task_result

# Texts used when a step brings nothing.
NO_LOGS = "No logs available"
ANALYSIS_FAILED = "Log analysis failed"
NO_FINDINGS = "No analysis available"

REPORT = (
    "Pod {POD} in namespace {NAMESPACE}\n"
    "Details: {DETAILS}\n"
    "Findings: {FINDINGS}\n"
    "Events:\n{EVENTS}\n"
    "Logs:\n{LOGS}"
)


def troubleshoot(
    pods: DataFrame,
    events_text: DataFrame,
    logs: DataFrame,
    findings: DataFrame,
) -> DataFrame:
    """One result per pod and page; page p holds page p of its events and of its log.

    ``pods(namespace, pod, details, error)`` are the pods asked for. A pod with
    an ``error`` ends there: its result holds only that error.
    ``events_text(namespace, pod, page, events_text)`` comes from
    ``format_events``; ``logs(namespace, pod, page, logs_text)`` are the lines;
    ``findings(namespace, pod, findings, failed)`` comes from log analysis.
    Output: ``namespace, pod, page, details, logs, findings, events_text, error``.
    """
    failed = pods.filter(F.col("error").isNotNull()).select(
        *POD_KEY,
        F.lit(0).alias("page"),
        F.lit(None).cast("string").alias("details"),
        F.lit(None).cast("string").alias("logs"),
        F.lit(None).cast("string").alias("findings"),
        F.lit(None).cast("string").alias("events_text"),
        F.concat(F.lit("Failed to get pod info: "), F.col("error")).alias("error"),
    )
    good = pods.filter(F.col("error").isNull()).select(*POD_KEY, F.col("details").alias("_details"))

    key = list(POD_KEY)
    told = events_text.select(*key, "page", F.col("events_text").alias("_events"))
    pages = told.join(logs.select(*key, "page", F.col("logs_text").alias("_logs")), [*key, "page"], "full")
    joined = good.join(findings.select(*key, F.col("findings").alias("_findings"), "failed"), key, "left").join(pages, key, "left")
    page = F.coalesce("page", F.lit(0))

    def shown(text: str, nothing: str) -> Column:
        return F.coalesce(text, F.when(page == 0, F.lit(nothing)).otherwise(F.lit("")))

    reported = joined.select(
        *POD_KEY,
        page.alias("page"),
        F.col("_details").alias("details"),
        shown("_logs", NO_LOGS).alias("logs"),
        F.when(F.coalesce("failed", F.lit(False)), F.lit(ANALYSIS_FAILED))
        .otherwise(F.coalesce("_findings", F.lit(NO_FINDINGS)))
        .alias("findings"),
        shown("_events", NO_EVENTS).alias("events_text"),
        F.lit(None).cast("string").alias("error"),
    )
    return reported.unionByName(failed)


def report(results: DataFrame) -> DataFrame:
    """Add ``result``: the task result whose only artifact is the report text."""
    text = F.lit(REPORT)
    for name, column in {
        "POD": "pod",
        "NAMESPACE": "namespace",
        "DETAILS": "details",
        "FINDINGS": "findings",
        "EVENTS": "events_text",
        "LOGS": "logs",
    }.items():
        text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(F.col(column), F.lit("")))
    return results.withColumn("result", task_result({"report": text}, F.col("error")))


def diagnose(
    pods: DataFrame,
    events: DataFrame,
    lines: DataFrame,
    seq: str = "seq",
    page_rows: int = PAGE_ROWS,
    line_seq: str = "line_no",
    failed: DataFrame | None = None,
) -> DataFrame:
    """The whole diagnosis from raw tables: events and lines to text, lines to
    findings, all joined to the pods. ``failed(namespace, pod)`` are pods whose
    log could not be analysed."""
    findings = pod_findings(lines).withColumn("failed", F.lit(False))
    if failed is not None:
        lost = failed.select(*POD_KEY).distinct()
        none = lost.select(*POD_KEY, F.lit(None).cast("string").alias("findings"), F.lit(True).alias("failed"))
        findings = findings.join(lost, list(POD_KEY), "left_anti").unionByName(none)
    return report(
        troubleshoot(
            pods,
            format_events(events, POD_KEY, seq, page_rows),
            paged_text(lines, POD_KEY, line_seq, F.col("line"), "\n", "logs_text", page_rows),
            findings,
        )
    )
