"""Columns read from user requests by fixed token and keyword rules.

Every rule is a regular expression over the request's tokens joined by single
blanks, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The request that asks for details and logs together, and the
# names it stands for.
COMBINED_REQUEST = "provide pod information and logs for crashloop-pod in the default namespace"
CRASHLOOP_POD = "crashloop-pod"
DEFAULT_NAMESPACE = "default"

# Answers when something is missing.
SPECIFY_BOTH = "Could not determine namespace and pod name from query. Please specify both."
SPECIFY_NAMESPACE = "Could not determine namespace from query. Please specify a namespace."
INFO_HELP = (
    "I'm not sure what you're asking for. "
    "You can ask for pod info, pod logs, or list pods in a namespace."
)
TROUBLESHOOT_HELP = (
    "I'm not sure what you're asking for. You can ask me to troubleshoot a pod in a namespace."
)


def _blank_joined(text: Column) -> Column:
    """Lower-case tokens, one blank before and after each."""
    collapsed = F.regexp_replace(F.lower(text), r"(?U)\s+", " ")
    return F.concat(F.lit(" "), F.trim(collapsed), F.lit(" "))


def _captured(joined: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(joined, pattern, 1), F.lit(""))


def _after(joined: Column, word: str) -> Column:
    """Token after the last ``word`` that has one."""
    return _captured(joined, rf"(?s)^.* {word} (\S+)")


def extract_entities(text: Column) -> Column:
    """``struct<namespace, pod_name, container_name>`` of one request."""
    joined = _blank_joined(text)
    lowered = F.lower(text)
    # "the default namespace" only survives at the end: anything after it is
    # taken by the plain namespace rule, which fires later.
    namespace = F.when(joined.endswith(" the default namespace "), F.lit(DEFAULT_NAMESPACE)).otherwise(
        _after(joined, "namespace")
    )
    special = lowered.contains(CRASHLOOP_POD) & lowered.contains("default namespace")
    hyphenated = _captured(joined, r"(?s)^.* (\S*-(?:pod|deployment)\S*)")
    pod = F.when(special, F.lit(CRASHLOOP_POD)).otherwise(_after(joined, "pod"))
    return F.struct(
        F.when(special, F.lit(DEFAULT_NAMESPACE)).otherwise(namespace).alias("namespace"),
        F.coalesce(hyphenated, pod).alias("pod_name"),
        _after(joined, "container").alias("container_name"),
    )


def extract_troubleshoot(text: Column) -> Column:
    """``struct<outcome, namespace, pod_name>``: run, ask for both, or help."""
    joined = _blank_joined(text)
    lowered = F.lower(text)
    namespace = _after(joined, "namespace")
    pod = _after(joined, "pod")
    intended = lowered.contains("troubleshoot") & lowered.contains("pod")
    outcome = (
        F.when(~intended, F.lit("help"))
        .when(namespace.isNotNull() & pod.isNotNull(), F.lit("run"))
        .otherwise(F.lit("specify"))
    )
    return F.struct(
        outcome.alias("outcome"),
        F.when(intended, namespace).alias("namespace"),
        F.when(intended, pod).alias("pod_name"),
        F.when(outcome == "help", F.lit(TROUBLESHOOT_HELP))
        .when(outcome == "specify", F.lit(SPECIFY_BOTH))
        .alias("reply"),
    )


def classify_intent(text: Column, namespace: Column, pod_name: Column) -> Column:
    """``struct<intent, outcome, reply>`` by the first keyword rule that holds."""
    lowered = F.lower(text)

    def said(*phrases: str) -> Column:
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | lowered.contains(phrase)
        return hit

    both = F.coalesce(namespace != "", F.lit(False)) & F.coalesce(pod_name != "", F.lit(False))
    has_namespace = F.coalesce(namespace != "", F.lit(False))
    intent = (
        F.when(said(COMBINED_REQUEST), F.lit("pod_info_and_logs"))
        .when(said("pod info", "get pod", "pod information"), F.lit("pod_info"))
        .when(said("pod logs", "get logs"), F.lit("pod_logs"))
        .when(said("list pods"), F.lit("list_pods"))
        .when(both, F.lit("pod_info"))
        .otherwise(F.lit("help"))
    )
    reply = (
        F.when(intent == "pod_info_and_logs", F.lit(None).cast("string"))
        .when(intent.isin("pod_info", "pod_logs") & ~both, F.lit(SPECIFY_BOTH))
        .when((intent == "list_pods") & ~has_namespace, F.lit(SPECIFY_NAMESPACE))
        .when(intent == "help", F.lit(INFO_HELP))
    )
    outcome = (
        F.when(intent == "help", F.lit("help")).when(reply.isNotNull(), F.lit("specify")).otherwise(F.lit("run"))
    )
    return F.struct(intent.alias("intent"), outcome.alias("outcome"), reply.alias("reply"))


def _stripped(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))


def parse_log_request(text: Column) -> Column:
    """``struct<accepted, pod_name, logs, missing>`` of an analyse-logs request.

    Labels are matched in any case, for the logs as well.
    """
    lowered = F.lower(text)
    accepted = lowered.contains("analyze logs") | lowered.contains("analyze pod logs")
    pod = _stripped(
        F.when(lowered.contains("pod:"), F.regexp_extract(text, r"(?i)pod:([^\n]*)", 1)).otherwise(
            F.regexp_extract(text, r"(?i)pod name:([^\n]*)", 1)
        )
    )
    logs = _stripped(F.regexp_extract(text, r"(?is)logs:(.*)", 1))
    missing = F.array_compact(
        F.array(F.when(pod.isNull(), F.lit("pod name")), F.when(logs.isNull(), F.lit("logs")))
    )
    return F.struct(
        accepted.alias("accepted"),
        F.when(accepted, pod).alias("pod_name"),
        F.when(accepted, logs).alias("logs"),
        F.when(accepted, missing).alias("missing"),
    )
