from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.operators.paging import paged_list, paged_text, with_pages


def skewed(spark, hot=1000, cold=20):
    """Key 'hot' owns most rows; one key is NULL and hot as well."""
    numbers = spark.range(hot).select(F.lit("hot").alias("k"), (F.col("id") * 7).alias("seq"))
    nulls = spark.range(hot).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("seq"))
    few = spark.range(cold).select(F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("k"), F.col("id").alias("seq"))
    return numbers.unionByName(nulls).unionByName(few)


def test_pages_are_exact_for_every_key(spark):
    paged = with_pages(skewed(spark), ["k"], "seq", page_rows=50)
    sizes = {(r.k, r.page): r["count"] for r in paged.groupBy("k", "page").count().collect()}
    assert {p for k, p in sizes if k == "hot"} == set(range(20))
    assert {p for k, p in sizes if k is None} == set(range(20))
    assert all(n == 50 for (k, _), n in sizes.items() if k in ("hot", None))
    assert all(page == 0 for k, page in sizes if k and k.startswith("c"))


def test_rows_of_one_number_are_spread(spark):
    df = spark.range(700).select(F.lit("k").alias("k"), F.lit(5).alias("seq"), "id")
    sizes = [r["count"] for r in with_pages(df, ["k"], "seq", page_rows=100).groupBy("page").count().collect()]
    assert sorted(sizes) == [100] * 7


def test_pages_keep_the_order(spark):
    pages = paged_list(skewed(spark), ["k"], "seq", F.col("seq"), "all", page_rows=50)
    hot = sorted(pages.filter("k = 'hot'").collect(), key=lambda r: r.page)
    assert [n for page in hot for n in page["all"]] == [7 * i for i in range(1000)]


def test_one_page_for_ordinary_keys(spark, rows):
    texts = paged_text(skewed(spark, hot=5), ["k"], "seq", F.col("seq").cast("string"), ",", "t")
    found = {r.k: (r.page, r.t) for r in texts.collect()}
    assert found["hot"] == (0, "0,7,14,21,28")
    assert found["c0"] == (0, "0,5,10,15")
    assert found[None] == (0, "0,1,2,3,4")


def test_negative_and_sparse_numbers(spark):
    df = spark.range(-500, 500).select(F.lit("k").alias("k"), (F.col("id") * 1_000_003).alias("seq"))
    pages = paged_list(df, ["k"], "seq", F.col("seq"), "all", page_rows=100)
    collected = sorted(pages.collect(), key=lambda r: r.page)
    assert [n for p in collected for n in p["all"]] == [i * 1_000_003 for i in range(-500, 500)]
    assert [len(p["all"]) for p in collected] == [100] * 10


def test_message_parts_of_a_hot_message(spark):
    from agentlake.operators.workflow import join_parts

    parts = spark.range(900).select(
        (F.col("id") % 3 * 0 + 1).alias("message_id"), F.col("id").alias("seq"), F.lit("A").alias("agent_name"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit(None).cast("string").alias("function_response"),
    )
    pages = join_parts(parts, page_rows=100).orderBy("page").collect()
    assert len(pages) > 4
    assert "\n".join(p.response for p in pages) == "\n".join(f"t{i}" for i in range(900))


def test_events_and_histories_of_hot_keys(spark):
    from agentlake.operators import cluster, workflow

    hot = spark.range(900).select(
        F.lit("n").alias("namespace"), F.lit("p").alias("pod"), F.col("id").alias("seq"), F.lit("Normal").alias("type"),
        F.col("id").cast("string").alias("reason"), F.lit("m").alias("message"), F.lit(1).alias("count"),
        F.lit("a").alias("first_ts"), F.lit("b").alias("last_ts"),
    )
    pods = spark.createDataFrame([("n", "p", "d"), ("n", "q", "d")], "namespace string, pod string, details string")
    info = cluster.pod_info(pods, hot, page_rows=100).orderBy("pod", "page").collect()
    assert [e.reason for page in info for e in page.events] == [str(i) for i in range(900)]
    assert info[-1].pod == "q" and info[-1].events == []
    messages = spark.range(900).select(
        F.lit("s").alias("stream_id"), F.col("id").alias("seq"), F.lit("c").alias("context_id"),
        F.col("id").cast("string").alias("query"), F.lit(False).alias("completed"),
    )
    pages = workflow.session_history(workflow.session_islands(messages, block_rows=70), page_rows=100)
    assert [q for p in pages.orderBy("page").collect() for q in p.history] == [str(i) for i in range(900)]


def test_alerts_of_a_hot_state(spark):
    from agentlake.operators.weather import SEPARATOR, format_alerts
    from agentlake.sources.items import read_features

    payloads = spark.range(600).select(
        F.lit("CA").alias("state"), F.col("id").alias("seq"),
        F.concat(F.lit('{"features": [{"properties": {"event": "e'), F.col("id").cast("string"), F.lit('"}}]}')).alias("text"),
    )
    pages = format_alerts(read_features(payloads, "text", ["state", "seq"]), page_rows=100).orderBy("page").collect()
    assert len(pages) > 3
    events = [a.split("\n")[1] for p in pages for a in p.alerts_text.split(SEPARATOR)]
    assert events == [f"Event: e{i}" for i in range(600)]
