from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from agentlake.functions.quantity import quantity
from agentlake.operators import cluster, logs, waits, weather
from agentlake.plans import diagnosis

POD = "namespace string, name string, phase string, containers array<struct<name:string,requests:map<string,string>>>"
SERVICE = (
    "namespace string, name string, cluster_ip string, deletion_timestamp timestamp, "
    "ports array<struct<port:int,protocol:string,node_port:int>>, selector map<string,string>"
)
EVENT = "namespace string, pod string, seq long, type string, reason string, message string, count int, first_ts string, last_ts string"


def test_pod_listing_uses_the_last_container_with_requests(spark, rows):
    pods = spark.createDataFrame(
        [
            ("default", "a", "Running", [("1", {"cpu": "100m", "memory": "64Mi"}), ("2", {"cpu": "1"}), ("3", {})]),
            ("default", "b", "Failed", [("1", None)]),
            ("default", "c", "Pending", []),
            ("other", "d", "Running", [("1", {"memory": "1Gi"})]),
        ],
        POD,
    )
    assert rows(cluster.list_pods(pods), "pod_name", "cpu_request", "memory_request") == [
        ("a", "1", "N/A"), ("b", "N/A", "N/A"), ("c", "N/A", "N/A"),
    ]
    assert rows(cluster.list_pods(pods, "other"), "pod_name", "cpu_request", "memory_request") == [("d", "N/A", "1Gi")]
    assert cluster.list_pods(pods, None).count() == 4


def test_service_listing(spark, rows):
    services = spark.createDataFrame(
        [
            ("default", "web", "10.0.0.1", None, [(80, "TCP", 30080), (53, "UDP", None)], {"app": "web", "tier": "x"}),
            ("default", "bare", "", None, None, None),
            ("default", "none", None, None, [], {}),
        ],
        SERVICE,
    ).withColumn("deletion_timestamp", F.when(F.col("name") == "bare", F.lit("2025-01-01").cast("timestamp")))
    shown = ("service_name", "status", "cluster_ip", "ports", "node_port", "selector")
    assert rows(cluster.list_services(services), *shown) == [
        ("bare", "Terminating", "N/A", "N/A", "N/A", "N/A"),
        ("none", "Active", "N/A", "N/A", "N/A", "N/A"),
        ("web", "Active", "10.0.0.1", "80/TCP, 53/UDP", "30080", "app=web, tier=x"),
    ]


@pytest.mark.parametrize(
    ("text", "value"), [("100m", 0.1), ("2", 2.0), ("64Mi", 64 * 2.0**20), ("1.5Gi", 1.5 * 2**30), ("x", None), ("5Zi", None)]
)
def test_quantity(spark, text, value):
    found = spark.createDataFrame([(text,)], "t string").select(quantity(F.col("t")).alias("q")).first().q
    assert found == value or abs(found - value) < 1e-9


def test_usage(spark, rows):
    text = "NAME    CPU(cores)   MEMORY(bytes)\npod-a   100m   64Mi\npod-b   1   1Gi\n\nnothing here\n"
    df = spark.createDataFrame([("ns", text), ("other", "pod-c 50m 1Mi")], "namespace string, text string")
    usage = cluster.parse_usage(df)
    assert rows(usage, "pod", "cpu") == [("pod-a", 0.1), ("pod-b", 1.0), ("pod-c", 0.05)]
    totals = {(r.namespace, r.pod): (round(r.cpu, 6), r.level) for r in cluster.namespace_usage(usage).collect()}
    assert totals[("ns", None)] == (1.1, 1) and totals[(None, None)] == (1.15, 3)


def events(spark):
    return spark.createDataFrame(
        [
            ("n", "a", 2, "Normal", "Pulled", "ok", 3, "t1", "t2"),
            ("n", "a", 1, None, None, None, None, None, None),
            ("n", "z", 1, "Normal", "x", "y", 1, "t", "t"),
        ],
        EVENT,
    )


def test_event_text_and_pod_info(spark):
    text = {r.pod: r.events_text for r in cluster.format_events(events(spark)).collect()}["a"]
    assert text.split("\n") == [
        "- Type: Unknown, Reason: Unknown, Message: No message, Count: 0, First Timestamp: Unknown, Last Timestamp: Unknown",
        "- Type: Normal, Reason: Pulled, Message: ok, Count: 3, First Timestamp: t1, Last Timestamp: t2",
    ]
    pods = spark.createDataFrame([("n", "a", "d"), ("n", "b", "d")], "namespace string, pod string, details string")
    info = {r.pod: r for r in cluster.pod_info(pods, events(spark)).collect()}
    assert [e.reason for e in info["a"].events] == [None, "Pulled"]
    assert info["b"].events == [] and info["b"].page == 0


def test_event_and_log_selection(spark, rows):
    pods = spark.createDataFrame([("n", "a"), ("n", "a"), ("m", "z")], "namespace string, name string")
    assert cluster.pod_events(events(spark), pods).count() == 2
    assert cluster.events_of_pod(events(spark), "n", "z").count() == 1
    lines = spark.createDataFrame(
        [("n", "a", "c1", 1, "x"), ("n", "a", "c2", 1, "y"), ("n", "b", "c1", 1, "z")],
        "namespace string, pod string, container string, line_no long, line string",
    )
    assert cluster.pod_logs(lines, "n", "a").count() == 2
    assert rows(cluster.pod_logs(lines, "n", "a", "c2"), "line") == [("y",)]
    asked = spark.createDataFrame(
        [("n", "a", None), ("n", "a", "c1"), ("n", "b", "c9")], "namespace string, pod string, container string"
    )
    assert rows(cluster.requested_logs(lines, asked), "line") == [("x",), ("y",)]


FAILING = [
    "Starting container...",
    "Simulating application error...",
    "ERROR: Could not connect to database at db-service:3306",
    "ERROR: Connection timeout after 30 seconds",
    "ERROR: Connection timeout after 45 seconds",
]


def failing_lines(spark):
    return spark.createDataFrame(
        [("n", "crashloop-pod", i, line) for i, line in enumerate(FAILING, 1)],
        "namespace string, pod string, line_no long, line string",
    )


def test_patterns_merge_numbers(spark):
    found = {r.template: (r.severity, r.lines) for r in logs.log_patterns(failing_lines(spark)).collect()}
    assert found["ERROR: Connection timeout after <n> seconds"] == ("error", 2)
    assert found["Starting container..."] == ("info", 1)
    top = logs.log_patterns(failing_lines(spark), top=1).collect()
    assert [r.template for r in top] == ["ERROR: Connection timeout after <n> seconds"]


def test_diagnosis(spark):
    pods = spark.createDataFrame(
        [("n", "crashloop-pod", "d", None), ("n", "quiet", "d", None), ("n", "gone", None, "not found")],
        "namespace string, pod string, details string, error string",
    )
    told = {r.pod: r for r in diagnosis.diagnose(pods, events(spark).filter("pod = 'none'"), failing_lines(spark)).collect()}
    assert told["crashloop-pod"].findings == "ApplicationError (4): Check application code for exceptions"
    assert told["quiet"].logs == diagnosis.NO_LOGS and told["quiet"].events_text == cluster.NO_EVENTS
    assert told["gone"].result.error == "Failed to get pod info: not found" and told["gone"].result.artifacts == {}
    report = told["crashloop-pod"].result.artifacts["report"]
    assert "Findings: ApplicationError" in report and "Details: d\n" in report
    assert told["crashloop-pod"].logs == "\n".join(FAILING) and report.endswith(FAILING[-1])
    # Pages of the log go on where the events have ended.
    paged = diagnosis.diagnose(pods, events(spark).filter("pod = 'none'"), failing_lines(spark), page_rows=2, failed=pods.filter("pod = 'quiet'"))
    read = [(r.page, r.logs, r.events_text) for r in paged.orderBy("page").collect() if r.pod == "crashloop-pod"]
    assert [(p, t) for p, t, _ in read] == [(i, "\n".join(FAILING[2 * i : 2 * i + 2])) for i in range(3)]
    assert [e for _, _, e in read] == [cluster.NO_EVENTS, "", ""]
    assert paged.filter("pod = 'quiet'").first().findings == diagnosis.ANALYSIS_FAILED


def test_failed_analysis(spark):
    pods = spark.createDataFrame([("n", "a", "d", None)], "namespace string, pod string, details string, error string")
    none = spark.createDataFrame([], "namespace string, pod string, page int, events_text string")
    logs_of = none.withColumnRenamed("events_text", "logs_text")
    failed = spark.createDataFrame([("n", "a", None, True)], "namespace string, pod string, findings string, failed boolean")
    assert diagnosis.troubleshoot(pods, none, logs_of, failed).first().findings == diagnosis.ANALYSIS_FAILED


def wait_model(status, deploys, timeout):
    answers = []
    for pod, start in deploys:
        hits = [ts for p, ts, reason in status if p == pod and reason == waits.CRASHLOOP and start <= ts < start + timeout]
        answers.append((pod, start, min(hits) if hits else None))
    return sorted(answers, key=str)


def test_wait_interval(spark):
    status = [("a", 100, waits.CRASHLOOP), ("a", 30, "Creating"), ("a", 119, waits.CRASHLOOP), ("b", 60, waits.CRASHLOOP),
              ("a", 100, waits.CRASHLOOP), ("c", -5, waits.CRASHLOOP)]
    deploys = [("a", 40), ("a", 41), ("a", 100), ("a", 100), ("a", 101), ("a", 120), ("b", 0), ("b", 1), ("d", 5), ("c", -60), ("c", -65)]
    s = spark.createDataFrame(status, "pod string, at long, waiting_reason string")
    d = spark.createDataFrame(deploys, "pod string, at long")
    ns = F.lit("n").alias("namespace")
    found = waits.crashloop_wait(
        s.select(ns, "pod", F.timestamp_seconds("at").alias("ts"), "waiting_reason"),
        d.select(ns, "pod", "at", F.timestamp_seconds("at").alias("ts")),
    ).select("pod", "at", F.unix_seconds("crashed_at").alias("hit"), "crashed")
    got = found.collect()
    assert sorted(((r.pod, r.at, r.hit) for r in got), key=str) == wait_model(status, deploys, 60)
    assert all(r.crashed == (r.hit is not None) for r in got)


def test_weather_texts(spark):
    periods = [(f"P{i}", 20 + i, "F", "5 mph", "N", "Sunny") for i in range(7)]
    df = spark.createDataFrame(
        [(1, periods), (2, periods[:2]), (3, [])],
        "id int, periods array<struct<name:string,temperature:int,temperatureUnit:string,windSpeed:string,"
        "windDirection:string,detailedForecast:string>>",
    )
    found = {r.id: r.forecast_text for r in weather.first_periods(df).collect()}
    assert found[1].count("---") == 4 and "P5" not in found[1]
    assert found[2].startswith("\nP0:\nTemperature: 20°F\nWind: 5 mph N\nForecast: Sunny\n\n---\n\nP1:")
    assert found[3] == ""
    points = spark.createDataFrame([("x",), ("y",), ("z",)], "point string")
    grid = spark.createDataFrame([("x", "k"), ("y", "lost")], "point string, forecast_key string")
    texts = spark.createDataFrame([("k", "fine")], "forecast_key string, forecast_text string")
    answers = {r.point: r.forecast_text for r in weather.forecast_for_points(points, grid, texts).collect()}
    assert answers == {"x": "fine", "y": weather.NO_FORECAST, "z": weather.NO_POINT}


def test_alerts_keep_payload_and_feature_order(spark):
    from agentlake.sources.items import EMPTY_FEATURES, read_features

    df = spark.createDataFrame(
        [
            ("CA", 2, '{"features": [{"properties": {"event": "c", "severity": null}}]}'),
            ("CA", 1, '{"features": [{"properties": {"event": "b"}}, {"properties": {"event": "a", "areaDesc": "x"}}]}'),
            ("NV", 1, '{"features": []}'),
        ],
        "state string, seq long, text string",
    )
    found = {r.state: r.alerts_text for r in weather.format_alerts(read_features(df, "text", ["state", "seq"])).collect()}
    assert found["NV"] == EMPTY_FEATURES
    blocks = found["CA"].split(weather.SEPARATOR)
    assert [b.split("\n")[1] for b in blocks] == ["Event: b", "Event: a", "Event: c"]
    assert blocks[1] == (
        "\nEvent: a\nArea: x\nSeverity: Unknown\nDescription: No description available\n"
        "Instructions: No specific instructions provided\n"
    )
    assert "Severity: Unknown" in blocks[2]


def test_random_waits_of_a_hot_pod(spark):
    import random

    rng = random.Random(5)
    pods = ["hot"] * 4 + ["a", "b"]
    status = [(rng.choice(pods), rng.randrange(0, 3000), rng.choice([waits.CRASHLOOP, "Creating"])) for _ in range(120)]
    deploys = [(rng.choice(pods), rng.randrange(-100, 3000)) for _ in range(300)]
    ns = F.lit("n").alias("namespace")
    s = spark.createDataFrame(status, "pod string, at long, waiting_reason string")
    d = spark.createDataFrame(deploys, "pod string, at long")
    found = waits.crashloop_wait(
        s.select(ns, "pod", F.timestamp_seconds("at").alias("ts"), "waiting_reason"),
        d.select(ns, "pod", "at", F.timestamp_seconds("at").alias("ts")),
        timeout=37,
    ).select("pod", "at", F.unix_seconds("crashed_at").alias("hit"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == wait_model(status, deploys, 37)
