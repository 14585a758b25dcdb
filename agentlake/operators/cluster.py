"""Pods, services, events, logs and usage of a cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions.quantity import quantity
from agentlake.operators.joins import same, skew_join
from agentlake.operators.paging import PAGE_ROWS, paged_list, paged_text

# Placeholders of the listings and texts.
NOT_AVAILABLE = "N/A"
POD_KEY = ("namespace", "pod")
NO_EVENTS = "No events found"


def _or_na(value: Column) -> Column:
    return F.coalesce(value, F.lit(NOT_AVAILABLE))


def list_pods(pods: DataFrame, namespace: str | None = "default") -> DataFrame:
    """``namespace, pod_name, status, cpu_request, memory_request``.

    The requests are those of the last container that has any; both values come
    from that one container. ``namespace=None`` lists every namespace.
    """
    if namespace is not None:
        pods = pods.filter(F.col("namespace") == F.lit(namespace))
    asking = F.filter("containers", lambda c: F.size(c["requests"]) > 0)
    requests = F.try_element_at(asking, F.lit(-1))["requests"]
    return pods.select(
        "namespace",
        F.col("name").alias("pod_name"),
        F.col("phase").alias("status"),
        _or_na(F.try_element_at(requests, F.lit("cpu"))).alias("cpu_request"),
        _or_na(F.try_element_at(requests, F.lit("memory"))).alias("memory_request"),
    )


def list_services(services: DataFrame, namespace: str | None = "default") -> DataFrame:
    """``namespace, service_name, status, cluster_ip, ports, node_port, selector``.

    A service without ports shows N/A for ports and node port.
    """
    if namespace is not None:
        services = services.filter(F.col("namespace") == F.lit(namespace))
    ports = F.transform(
        "ports", lambda p: F.concat_ws("/", p["port"].cast("string"), p["protocol"])
    )
    open_ports = F.filter(F.col("ports").getField("node_port"), lambda n: n.isNotNull() & (n != 0))
    pairs = F.transform(
        F.map_entries("selector"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )

    def listed(values: Column) -> Column:
        return F.when(F.size(values) > 0, F.array_join(values, ", "))

    return services.select(
        "namespace",
        F.col("name").alias("service_name"),
        F.when(F.col("deletion_timestamp").isNull(), F.lit("Active"))
        .otherwise(F.lit("Terminating"))
        .alias("status"),
        _or_na(F.nullif(F.col("cluster_ip"), F.lit(""))).alias("cluster_ip"),
        _or_na(listed(ports)).alias("ports"),
        _or_na(listed(open_ports.cast("array<string>"))).alias("node_port"),
        _or_na(listed(pairs)).alias("selector"),
    )


_AMOUNT = r"(?:[0-9.]+[A-Za-z]*|<unknown>)"
_USAGE = rf"^\s*(\S+)(?:\s+(\S+))?\s+({_AMOUNT})\s+({_AMOUNT})\s*$"
_HEADING = r"^\s*(POD|NAME|NAMESPACE)\b.*\bMEMORY\b"


def _usage_lines(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    lines = df.select(*keys, F.explode(F.split(F.col(text), r"\r?\n")).alias("line"))
    return lines.filter((F.trim("line") != "") & ~F.col("line").rlike(_HEADING))


def parse_usage(df: DataFrame, text: str = "text", keys: Sequence[str] = ("namespace",)) -> DataFrame:
    """Usage listings to ``keys, pod, container, cpu, memory`` with numeric quantities.

    ``container`` is NULL in a listing of whole pods, and an amount is NULL
    where the listing says ``<unknown>``. ``usage_rejects`` returns the lines
    that hold something else.
    """
    lines = _usage_lines(df, text, keys).filter(F.col("line").rlike(_USAGE))

    def amount(place: int) -> Column:
        found = F.regexp_extract("line", _USAGE, place)
        return F.when(found != "<unknown>", quantity(found))

    return lines.select(
        *keys,
        F.regexp_extract("line", _USAGE, 1).alias("pod"),
        F.nullif(F.regexp_extract("line", _USAGE, 2), F.lit("")).alias("container"),
        amount(3).alias("cpu"),
        amount(4).alias("memory"),
    )


def usage_rejects(df: DataFrame, text: str = "text", keys: Sequence[str] = ("namespace",)) -> DataFrame:
    """Lines of usage listings that ``parse_usage`` cannot read: ``keys, line``."""
    return _usage_lines(df, text, keys).filter(~F.col("line").rlike(_USAGE))


def namespace_usage(usage: DataFrame) -> DataFrame:
    """Usage per pod, per namespace (``pod`` NULL) and in total (both NULL)."""
    return usage.rollup("namespace", "pod").agg(
        F.sum("cpu").alias("cpu"),
        F.sum("memory").alias("memory"),
        F.count(F.lit(1)).alias("samples"),
        F.grouping_id().cast("int").alias("level"),
    )


def events_of_pod(events: DataFrame, namespace: str, pod: str) -> DataFrame:
    """Field selector: events of one object, filtered at the scan."""
    return events.filter((F.col("namespace") == F.lit(namespace)) & (F.col("pod") == F.lit(pod)))


def pod_events(events: DataFrame, pods: DataFrame) -> DataFrame:
    """Events whose object is one of ``pods`` (namespace, name)."""
    wanted = pods.select("namespace", F.col("name").alias("pod")).dropna().distinct()
    return skew_join(events, wanted, POD_KEY, "left_semi")


def pod_logs(
    logs: DataFrame, namespace: str, pod: str, container: str | None = None
) -> DataFrame:
    """Log lines of a pod, of one container only when it is named."""
    chosen = (F.col("namespace") == F.lit(namespace)) & (F.col("pod") == F.lit(pod))
    if container:
        chosen = chosen & (F.col("container") == F.lit(container))
    return logs.filter(chosen)


def requested_logs(logs: DataFrame, requests: DataFrame) -> DataFrame:
    """Log lines asked for by any request (namespace, pod, container or NULL).

    A request without a container stands for all of the pod's containers. Each
    line appears once, and the lines are read once.
    """
    asked = requests.dropna(subset=list(POD_KEY)).select(*[F.col(c).alias(f"_{c}") for c in (*POD_KEY, "container")]).distinct()
    of_pod = same(logs, asked, {c: f"_{c}" for c in POD_KEY})
    return logs.join(asked, of_pod & (asked["_container"].isNull() | (asked["_container"] == logs["container"])), "left_semi")


def _event_line() -> Column:
    def shown(name: str, default: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    return F.concat(
        F.lit("- Type: "), shown("type", "Unknown"),
        F.lit(", Reason: "), shown("reason", "Unknown"),
        F.lit(", Message: "), shown("message", "No message"),
        F.lit(", Count: "), shown("count", "0"),
        F.lit(", First Timestamp: "), shown("first_ts", "Unknown"),
        F.lit(", Last Timestamp: "), shown("last_ts", "Unknown"),
    )


def format_events(
    events: DataFrame,
    keys: Sequence[str] = POD_KEY,
    seq: str = "seq",
    page_rows: int = PAGE_ROWS,
    then: Sequence[str] = (),
) -> DataFrame:
    """One line per event, in order: ``keys, page, events_text``.

    ``then`` orders events of one ``seq``, such as items of one list.
    """
    return paged_text(events, keys, seq, _event_line(), "\n", "events_text", page_rows, then)


def pod_info(
    pods: DataFrame, events: DataFrame, seq: str = "seq", page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Pod details with the pod's own events: ``namespace, pod, details, page, events``.

    A pod without events has one page with an empty list.
    """
    event = F.struct("type", "reason", "message", "count", "first_ts", "last_ts")
    collected = paged_list(events, POD_KEY, seq, event, "events", page_rows)
    none = F.array().cast(collected.schema["events"].dataType)
    return pods.join(collected, list(POD_KEY), "left").select(
        "namespace",
        "pod",
        "details",
        F.coalesce("page", F.lit(0)).alias("page"),
        F.coalesce("events", none).alias("events"),
    )
