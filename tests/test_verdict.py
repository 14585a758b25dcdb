"""Rows that used to be lost or let in by accident."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.functions.jsontext import is_object, strict_json
from agentlake.operators import cluster, weather
from agentlake.operators.search import text_search
from agentlake.operators.vectors import top_match


def test_json_with_anything_behind_it_is_no_document(spark):
    texts = ['{"a":1}', '{"a":1}] junk', "1],[2", '"x"] and more', '{"a":1},{"b":2}', "", "  ", None, '{"a":1}],"x"', "[1,2]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ok for r in df.select(strict_json(F.col("t")).isNotNull().alias("ok")).collect()]
    assert got == [True, False, False, False, False, False, False, False, False, True]
    assert df.filter(is_object(strict_json(F.col("t")))).count() == 1


def test_a_word_of_nearly_every_text_still_matches(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("common w"), F.col("id").cast("string")).alias("text"))
    queries = spark.createDataFrame([(1, "common")], "query_id long, text string")
    found = text_search(docs, queries, k=5000)
    assert found.count() == 3000


def test_a_vector_that_is_no_number_never_wins(spark):
    items = spark.createDataFrame([(1, [float("nan"), 1.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0])], "i long, embedding array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "q long, embedding array<double>")
    for k, expected in ((1, [2]), (2, [2, 3])):
        got = top_match(queries, items, "q", "i", k=k).orderBy("rank").collect()
        assert [r.i if "i" in r else r.item for r in got] == expected


def test_a_period_without_wind_stays(spark):
    kind = "k string, periods array<struct<name:string,temperature:int,temperatureUnit:string,windSpeed:string,windDirection:string,detailedForecast:string>>"
    df = spark.createDataFrame([("x", [("a", 1, "C", "5", None, "f"), ("b", None, "C", "5", "N", "g")])], kind)
    text = weather.first_periods(df).first()["forecast_text"]
    assert "Wind: 5 None" in text and "Temperature: None" in text and text.count("Forecast:") == 2


def test_usage_lines_of_every_form(spark):
    text = "NAME CPU(cores) MEMORY(bytes)\npod-a 5m 10Mi\npod-b <unknown> <unknown>\nPOD NAME CPU(cores) MEMORY(bytes)\npod-c main 1m 2Mi\n\nerror: no metrics"
    df = spark.createDataFrame([("ns", text)], "namespace string, text string")
    got = {(r.pod, r.container): (r.cpu, r.memory) for r in cluster.parse_usage(df).collect()}
    assert got == {("pod-a", None): (0.005, 10 * 2**20), ("pod-b", None): (None, None), ("pod-c", "main"): (0.001, 2 * 2**20)}
    assert [r.line for r in cluster.usage_rejects(df).collect()] == ["error: no metrics"]
