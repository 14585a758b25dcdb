from __future__ import annotations

import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agentlake.functions import replies, requests
from agentlake.functions.template import render_template

RUN = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def column_of(spark, texts, build, *names):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.select("i", build(F.col("t")).alias("r")).select("i", *[f"r.{n}" for n in names]).collect()
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: r.i)]


# --- entities -----------------------------------------------------------------


def entity_model(text):
    """The token rules, one token at a time."""
    words = text.lower().split()
    found = dict.fromkeys(("namespace", "pod", "container"))
    for at, word in enumerate(words):
        following = words[at + 1 : at + 3]
        if word in found and following:
            found[word] = following[0]
        if word == "the" and following == ["default", "namespace"]:
            found["namespace"] = "default"
    if "crashloop-pod" in text.lower() and "default namespace" in text.lower():
        found["namespace"], found["pod"] = "default", "crashloop-pod"
    hyphenated = [w for w in words if "-pod" in w or "-deployment" in w]
    if hyphenated:
        found["pod"] = hyphenated[-1]
    return found["namespace"], found["pod"], found["container"]


EXAMPLES = [
    "Get pod information for nginx-pod in namespace default",
    "Show logs for crashloop-pod in the default namespace",
    "show it in the default namespace please",
    "the default namespace",
    "namespace a namespace b",
    "namespace namespace c",
    "pod",
    "",
    "  pod\n\tx  ",
    "Pod web container main NAMESPACE Prod",
    "my-deployment-7 and api-pod-9 pod other",
    "namespace",
]


def test_entities_of_examples(spark):
    found = column_of(spark, EXAMPLES, requests.extract_entities, "namespace", "pod_name", "container_name")
    assert found == [entity_model(t) for t in EXAMPLES]
    assert found[0] == ("default", "nginx-pod", None)
    assert found[2] == ("please", None, None)


words = st.sampled_from(
    ["pod", "namespace", "container", "the", "default", "crashloop-pod", "x-deployment", "a", "Prod", "in", "web-pod"]
)


@RUN
@given(st.lists(st.lists(words, max_size=9), min_size=20, max_size=40))
def test_entities_match_the_rules(spark, sentences):
    texts = [" ".join(s) for s in sentences]
    found = column_of(spark, texts, requests.extract_entities, "namespace", "pod_name", "container_name")
    assert found == [entity_model(t) for t in texts]


def test_troubleshoot(spark):
    texts = [
        "Troubleshoot pod a in namespace b",
        "troubleshoot the pod",
        "pod a namespace b",
        "Troubleshoot pod a pod c namespace d",
    ]
    found = column_of(spark, texts, requests.extract_troubleshoot, "outcome", "namespace", "pod_name", "reply")
    assert found == [
        ("run", "b", "a", None),
        ("specify", None, None, requests.SPECIFY_BOTH),
        ("help", None, None, requests.TROUBLESHOOT_HELP),
        ("run", "d", "c", None),
    ]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("provide pod information and logs for crashloop-pod in the default namespace", ("pod_info_and_logs", "run")),
        ("get pod logs pod a namespace b", ("pod_info", "run")),
        ("pod logs pod a namespace b", ("pod_logs", "run")),
        ("get logs", ("pod_logs", "specify")),
        ("list pods namespace b", ("list_pods", "run")),
        ("list pods", ("list_pods", "specify")),
        ("web-pod namespace b", ("pod_info", "run")),
        ("hello", ("help", "help")),
    ],
)
def test_intent(spark, text, expected):
    def build(t):
        e = requests.extract_entities(t)
        return requests.classify_intent(t, e["namespace"], e["pod_name"])

    assert column_of(spark, [text], build, "intent", "outcome") == [expected]


def test_log_request(spark):
    texts = [
        "Analyze logs\nPod: web\nLogs: one\ntwo ",
        "analyze pod logs\npod name:  api\n",
        "analyze logs pod:",
        "Pod: web\nLogs: x",
        "analyze logs POD: a b \r\nlogs:   ",
    ]
    found = column_of(spark, texts, requests.parse_log_request, "accepted", "pod_name", "logs", "missing")
    assert found == [
        (True, "web", "one\ntwo", []),
        (True, "api", None, ["logs"]),
        (True, None, None, ["pod name", "logs"]),
        (False, None, None, None),
        (True, "a b", None, ["logs"]),
    ]


# --- replies ------------------------------------------------------------------


def reply_model(text):
    """(type, complete, ask, content) with content read back from JSON."""
    data, fenced = text, False
    for pattern in replies.FENCES:
        match = re.search(pattern, text, re.DOTALL)
        if match:
            fenced, data = True, match.group(1)
            try:
                data = json.loads(data)
            except json.JSONDecodeError:
                pass
            break
    if fenced and isinstance(data, dict):
        if data.get("status") == "input_required":
            if "question" not in data:
                return "text", True, False, replies.FAILED_TEXT
            return "text", False, True, data["question"]
        return "data", True, False, data
    if isinstance(data, str):
        try:
            return "data", True, False, json.loads(data)
        except json.JSONDecodeError:
            return "text", True, False, data
    return "text", True, False, data


pieces = st.sampled_from(
    ["```\n", "\n```", "```json ", "```json\n", "```", "```tool_outputs ", '{"status": "input_required"}', '{"a": 1}',
     '{"status": "input_required", "question": "why?"}', '"word"', '"[1]"', "[1, 2]", "12", "plain", " ", "\n", "{"]
)


@RUN
@given(st.lists(st.lists(pieces, max_size=6), min_size=30, max_size=60))
def test_replies_match_the_rules(spark, made):
    texts = ["".join(p) for p in made]
    found = column_of(
        spark, texts, replies.normalize_response,
        "response_type", "is_task_complete", "require_user_input", "content",
    )
    for text, (kind, complete, ask, content) in zip(texts, found):
        want = reply_model(text)
        assert (kind, complete, ask) == want[:3], text
        if isinstance(want[3], str) and kind == "text":
            assert content == want[3], text
        else:
            assert json.loads(content) == want[3], text


def test_object_fence(spark, rows):
    df = spark.createDataFrame([('a ```json {"x": {"y": 1}} ``` b',), ("none",)], "t string")
    assert rows(df.select(replies.extract_object(F.col("t")))) == [("none",), ('{"x": {"y": 1}}',)]


def test_planner_response(spark):
    df = spark.createDataFrame(
        [("input_required", "q", "c"), ("error", "q", "c"), ("completed", "q", "c"), (None, "q", "c")],
        "status string, question string, content string",
    )
    built = replies.planner_response(F.col("status"), F.col("question"), F.col("content"))
    assert [tuple(r.r) for r in df.select(built.alias("r")).collect()] == [
        ("text", False, True, "q"),
        ("text", False, True, "q"),
        ("data", True, False, "c"),
        (None, False, True, replies.UNABLE_TEXT),
    ]


def test_template_replaces_in_turn(spark):
    df = spark.createDataFrame([("{B}", "done", None)], "a string, b string, c string")
    text = render_template(df, "{A} and {B}{C}", {"A": "a", "B": "b", "C": "c"}).first().rendered
    assert text == "done and done"
