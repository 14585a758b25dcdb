from __future__ import annotations

import json

from pyspark.sql import functions as F

from agentlake.functions.jsontext import field, strict_json
from agentlake.operators import lookup
from agentlake.sources import items, sinks
from agentlake.sources.cards import read_cards, with_card_uri
from agentlake.sources.logs import read_logs, split_logs

CARD = {
    "name": "Sample Agent",
    "provider": None,
    "capabilities": {"streaming": "True", "pushNotifications": "False"},
    "skills": [{"id": "a", "tags": ["book"], "examples": ["x"], "inputModes": None}, {"id": "b", "tags": ["find", "go"]}],
}


def card_folder(tmp_path):
    folder = tmp_path / "cards"
    (folder / "inner").mkdir(parents=True)
    (folder / "good.json").write_text(json.dumps(CARD, indent=2))
    (folder / "quiet.v2.JSON").write_text(json.dumps({**CARD, "capabilities": {"streaming": "False"}}))
    (folder / "broken.json").write_text('{"name": ')
    (folder / "trailing.json").write_text('{"a": 1} junk')
    (folder / "empty.json").write_text("")
    (folder / "latin.json").write_bytes(b'{"a": "\xff\xfe"}')
    (folder / "notes.txt").write_text("{}")
    (folder / "inner" / "deep.json").write_text("{}")
    return str(folder)


def test_card_scan(spark, rows, tmp_path):
    cards = read_cards(spark, card_folder(tmp_path))
    assert rows(cards, "card_uri") == [("resource://agent_cards/good",), ("resource://agent_cards/quiet.v2",)]
    kept = cards.filter("card_uri like '%good'").first()
    assert json.loads(kept.agent_card) == CARD


def test_missing_and_empty_card_folder(spark, tmp_path):
    assert read_cards(spark, str(tmp_path / "nowhere")).count() == 0
    (tmp_path / "none").mkdir()
    assert read_cards(spark, str(tmp_path / "none")).count() == 0


def test_card_lookups(spark, rows, tmp_path):
    cards = read_cards(spark, card_folder(tmp_path))
    assert lookup.list_cards(cards).count() == 2
    assert lookup.get_card(cards, "good").count() == 1
    assert lookup.get_card(cards, "absent").count() == 0
    names = spark.createDataFrame([("good",), ("absent",)], "name string")
    assert rows(lookup.get_cards(cards, names), "name", "found") == [("absent", False), ("good", True)]
    assert rows(lookup.filter_cards(cards, streaming=True), "card_uri") == [("resource://agent_cards/good",)]
    assert lookup.filter_cards(cards, tag="go").count() == 2
    assert lookup.filter_cards(cards, streaming=False, tag="nothing").count() == 0


def test_card_uri_drops_only_the_last_suffix(spark, rows):
    df = spark.createDataFrame([("a.b.json",), ("plain",), (".json",), ("sp%20ace.json",)], "file_name string")
    assert rows(with_card_uri(df), "card_uri") == [
        ("resource://agent_cards/.json",),
        ("resource://agent_cards/a.b",),
        ("resource://agent_cards/plain",),
        ("resource://agent_cards/sp ace",),
    ]


def test_strict_json(spark):
    good = ['{"a": 1}', "[1, 2]", "12", '"x"', "null", " {} "]
    bad = ['{"a":1} junk', '"name":"b"', "12 abc", "plain", "", "{"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    parsed = {r.t: r.ok for r in df.select("t", strict_json(F.col("t")).isNotNull().alias("ok")).collect()}
    assert [parsed[t] for t in good] == [True] * len(good)
    assert [parsed[t] for t in bad] == [False] * len(bad)


def test_missing_and_null_fields(spark):
    df = spark.createDataFrame([('{"a": null}',), ("{}",), ('{"a": "v"}',)], "t string")
    doc = strict_json(F.col("t"))
    found = df.select(
        "t", field(doc, "$.a", "d").alias("loose"), field(doc, "$.a", "d", strict_missing=True).alias("strict")
    ).collect()
    assert [(r.loose, r.strict) for r in found] == [("d", None), ("d", "d"), ("v", "v")]


def test_items_and_errors(spark, rows):
    df = spark.createDataFrame(
        [(1, '{"items": [{"n": 1}, {"n": 2}]}'), (2, "no json"), (3, '{"items": []}'), (4, '{"kind": "x"}'), (5, "[]")],
        "id int, text string",
    )
    found, errors = items.read_items(df, "text", ["id"])
    assert rows(found.select("id", "pos", F.try_variant_get("item", "$.n", "int"))) == [(1, 0, 1), (1, 1, 2)]
    assert rows(errors) == [(2, items.BAD_JSON)]


def test_features(spark, rows):
    df = spark.createDataFrame(
        [
            (1, '{"features": [{"properties": {"event": "a"}}, {"properties": {"event": "b"}}]}'),
            (2, '{"features": []}'),
            (3, "{}"),
            (4, "broken"),
            (5, '{"features": null}'),
        ],
        "id int, text string",
    )
    found = items.read_features(df, "text", ["id"])
    event = F.try_variant_get("properties", "$.event", "string").alias("event")
    assert rows(found.select("id", "status", "pos", event)) == [
        (1, None, 0, "a"),
        (1, None, 1, "b"),
        (2, items.EMPTY_FEATURES, None, None),
        (3, items.NO_FEATURES, None, None),
        (4, items.NO_FEATURES, None, None),
        (5, items.EMPTY_FEATURES, None, None),
    ]


def test_log_files_are_numbered_across_splits(spark, tmp_path):
    folder = tmp_path / "logs" / "default" / "web-1"
    folder.mkdir(parents=True)
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(3000)]
    (folder / "main.log").write_text("\n".join(lines) + "\n")
    (folder / "side.log").write_text("only\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        logs = read_logs(spark, str(tmp_path / "logs"))
        main = logs.filter("container = 'main'").orderBy("line_no").collect()
        side = logs.filter("container = 'side'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.line_no, r.line) for r in main] == list(enumerate(lines, 1))
    assert (main[0].namespace, main[0].pod) == ("default", "web-1")
    assert [(r.line_no, r.line) for r in side] == [(1, "only")]


def test_split_logs(spark, rows):
    df = spark.createDataFrame([("p", "a\nb\r\n\nc\n"), ("q", ""), ("r", "x"), ("s", None)], "pod string, text string")
    assert rows(split_logs(df, ["pod"], "text")) == [
        ("p", 1, "a"), ("p", 2, "b"), ("p", 3, ""), ("p", 4, "c"), ("r", 1, "x"),
    ]


def test_envelopes_page_a_hot_key(spark):
    df = spark.range(1000).select(F.lit("ns").alias("namespace"), F.col("id").alias("seq"), F.col("id").alias("v"))
    pages = sinks.to_envelope(df, ["namespace"], "seq", ["v"], "results", page_rows=100).collect()
    values = [row["v"] for p in sorted(pages, key=lambda p: p.page) for row in json.loads(p.envelope)["results"]]
    assert values == list(range(1000))
    assert len(pages) >= 5


def test_empty_envelope_message(spark):
    none = spark.createDataFrame([], "namespace string, page int, envelope string")
    asked = spark.createDataFrame([("dev",)], "namespace string")
    answer = sinks.envelopes_for(asked, none, "namespace", "services").first()
    assert json.loads(answer.envelope) == {"message": "No services found in namespace 'dev'"}


def test_task_result_and_markdown(spark):
    df = spark.createDataFrame([("ok", None), ("x", "boom")], "text string, error string")
    result = df.select(sinks.task_result({"report": F.col("text")}, F.col("error")).alias("r")).collect()
    assert [(r.r.artifacts, r.r.error) for r in result] == [({"report": "ok"}, None), ({}, "boom")]
    assert sinks.markdown_header({"a": "A", "b": "B"}) == "| A | B |\n| --- | --- |"
