"""Registry, vector and search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.fixtures import Fixtures
from agentlake.functions.jsontext import strict_json
from agentlake.functions.vectors import dot
from agentlake.operators import embedindex, lookup, search, searchindex, vectors
from agentlake.plans import agents
from agentlake.plans.catalog import query
from agentlake.session import scratch_path, written
from agentlake.sources.cards import read_cards as read_card_files
from agentlake.sources.cards import with_card_uri as card_uri_of


def _cards(f: Fixtures) -> DataFrame:
    return f.card_texts.withColumn("card", strict_json(F.col("agent_card")))


_SCORED = """pairs as (
    select a.vec_id, b.vec_id as item,
           round(list_dot_product(cast(a.embedding as double[]), cast(b.embedding as double[])), 6) as score
    from embeddings a join embeddings b on a.vec_id <> b.vec_id)"""


@query(
    f"""with {_SCORED}
    select vec_id, item, score, 1 as rank from pairs
    qualify row_number() over (partition by vec_id order by score desc, item) = 1"""
)
def top_match(f: Fixtures) -> DataFrame:
    """The nearest other vector of every vector."""
    table = f.tables["embeddings"]
    return vectors.top_match(table, table, "vec_id", "vec_id", exclude_self=True)


@query(
    f"""with {_SCORED}
    select vec_id, item, score, cast(row_number() over (partition by vec_id order by score desc, item) as int) as rank
    from pairs qualify rank <= 5"""
)
def top_five_matches(f: Fixtures) -> DataFrame:
    table = f.tables["embeddings"]
    return vectors.top_match(table, table, "vec_id", "vec_id", k=5, exclude_self=True)


@query(
    """select vec_id, round(list_dot_product(cast(embedding as double[]), cast(embedding as double[])), 6) as score
    from embeddings"""
)
def dot_product(f: Fixtures) -> DataFrame:
    return f.tables["embeddings"].select(
        "vec_id", F.round(dot(F.col("embedding"), F.col("embedding")), 6).alias("score")
    )


_CARD_PARTS = """select distinct p_brand, p_type, concat('resource://agent_cards/',
    lower(replace(p_brand, '#', '_')), '_', lower(p_type)) as card_uri from part"""


@query(
    """select distinct concat(p_brand, ' agent') as name, p_type in ('ECONOMY', 'PROMO') as streaming, 2 as tags,
    true as has_uri from part"""
)
def read_cards(f: Fixtures) -> DataFrame:
    """Write one file per card to the shared folder, then scan the folder.

    There is one card per brand and type, however large the part table is.
    """
    path = scratch_path(f.spark, "cards")
    schema = "name string, capabilities struct<streaming:string>, skills array<struct<id:string,tags:array<string>>>"
    cards = f.card_texts.select(F.from_json("agent_card", schema).alias("c")).select("c.*")
    cards.write.option("maxRecordsPerFile", 1).json(path)
    return read_card_files(f.spark, path).select(
        F.try_variant_get("card", "$.name", "string").alias("name"),
        (F.try_variant_get("card", "$.capabilities.streaming", "string") == "True").alias("streaming"),
        F.size(F.try_variant_get("card", "$.skills[0].tags", "array<string>")).alias("tags"),
        F.col("card_uri").startswith("resource://agent_cards/part-").alias("has_uri"),
    ).distinct()


@query(
    """select page_id, concat('resource://agent_cards/page.', cast(page_id as string)) as card_uri from pages"""
)
def with_card_uri(f: Fixtures) -> DataFrame:
    named = f.tables["pages"].select(
        "page_id", F.concat(F.lit("page."), F.col("page_id").cast("string"), F.lit(".JSON")).alias("file_name")
    )
    return card_uri_of(named).select("page_id", "card_uri")


@query(f"select card_uri from ({_CARD_PARTS}) c")
def list_cards(f: Fixtures) -> DataFrame:
    return lookup.list_cards(_cards(f))


@query(
    f"""with cards as ({_CARD_PARTS}),
    asked as (select p_partkey, case when p_partkey % 3 = 0 then concat('absent_', lower(p_type))
                     else concat(lower(replace(p_brand, '#', '_')), '_', lower(p_type)) end as name from part)
    select p_partkey, name, card_uri is not null as found
    from asked left join cards on card_uri = concat('resource://agent_cards/', name)"""
)
def get_cards(f: Fixtures) -> DataFrame:
    part = f.tables["part"]
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    name = F.when(F.col("p_partkey") % 3 == 0, F.lit("absent")).otherwise(brand)
    asked = part.select("p_partkey", F.concat(name, F.lit("_"), F.lower("p_type")).alias("name"))
    names = asked.select("name").distinct()
    found = lookup.get_cards(_cards(f), names).select(F.col("name").alias("_name"), "found")
    return asked.join(found, asked["name"] == found["_name"]).select("p_partkey", "name", "found")


@query(f"select card_uri from ({_CARD_PARTS}) c where p_type = 'PROMO'")
def filter_cards(f: Fixtures) -> DataFrame:
    return lookup.filter_cards(_cards(f), streaming=True, tag="promo").select("card_uri")


_BUCKETS = """token_counts as (
    select id, cast(concat('0x', substr(md5(token), 1, 8)) as bigint) % 256 as bucket, count(*) as n
    from (select id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as token from texts)
    group by all)"""


_EMBEDDED = f"""with texts as (select task_id as id, description as text from card_tasks), {_BUCKETS},
    norms as (select id, sqrt(cast(sum(n * n) as double)) as norm from token_counts group by id)
    select id as task_id, cast(max(bucket) as int) as last_bucket, round(sum(n / norm), 4) as total
    from token_counts join norms using (id) group by id"""


def _shown(embedded: DataFrame) -> DataFrame:
    filled = F.filter(F.sequence(F.lit(0), F.lit(255)), lambda i: F.get("embedding", i) > 0)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return embedded.select(
        "task_id", F.array_max(filled).alias("last_bucket"), F.round(total, 4).alias("total")
    )


@query(_EMBEDDED, ("card_tasks",))
def embed(f: Fixtures) -> DataFrame:
    return _shown(vectors.embed(f.card_tasks, "description"))


@query(_EMBEDDED, ("card_tasks",))
def stored_embeddings(f: Fixtures) -> DataFrame:
    """The same rows from vectors kept over two refreshes: other texts, then the present ones."""
    path = scratch_path(f.spark, "task-vectors")
    changed = F.when(F.col("task_id") % 3 == 0, F.concat(F.lit("once "), "description")).otherwise(F.col("description"))
    embedindex.refresh(f.card_tasks.withColumn("description", changed), path, 0, "description")
    embedindex.refresh(f.card_tasks, path, 1, "description")
    return _shown(embedindex.with_stored(f.card_tasks, path, "description"))


@query(
    f"""with texts as (
        select concat('t', cast(task_id as string)) as id, description as text from card_tasks
        union all select card_uri, agent_card from card_texts), {_BUCKETS},
    norms as (select id, sqrt(cast(sum(n * n) as double)) as norm from token_counts group by id),
    unit as (select id, bucket, cast(cast(n / norm as float) as double) as w from token_counts join norms using (id)),
    pairs as (
        select a.id, b.id as card_uri, round(sum(a.w * b.w), 6) as score
        from unit a join unit b on a.bucket = b.bucket
        where a.id like 't%' and b.id like 'resource%' group by all)
    select cast(substr(id, 2) as bigint) as task_id, card_uri, score from pairs
    qualify row_number() over (partition by id order by score desc, card_uri) = 1""",
    ("card_tasks", "card_texts"),
)
def assign_agents(f: Fixtures) -> DataFrame:
    indexed, _, _ = written(agents.index_cards(f.card_texts), "card-index")
    return agents.assign_agents(f.card_tasks, indexed)


_SEARCH = """with d as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as words from documents),
    q as (select distinct item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) as token from benchmark),
    size as (select cast(count(*) as double) as docs, avg(len(words)) as mean_len from d),
    tf as (select doc_id, doc_len, token, count(*) as tf
           from (select doc_id, len(words) as doc_len, unnest(words) as token from d)
           where token in (select token from q) group by all),
    df as (select token, count(*) as df from tf group by token),
    scored as (
        select item_id, doc_id, round(sum(
                   ln(1 + (docs - df + 0.5) / (df + 0.5))
                   * (tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * doc_len / mean_len)))), 6) as score
        from q join tf using (token) join df using (token) cross join size group by item_id, doc_id)
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank,
           doc_id, score
    from scored qualify rank <= 10"""


@query(_SEARCH)
def text_search(f: Fixtures) -> DataFrame:
    return search.text_search(f.tables["documents"], f.tables["benchmark"], query_key="item_id")


@query(_SEARCH)
def indexed_search(f: Fixtures) -> DataFrame:
    """The same rows from a stored index of two segments."""
    docs, path = f.tables["documents"], scratch_path(f.spark, "documents-index")
    odd = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    searchindex.add_documents(docs.filter(~odd), path, 0)
    searchindex.add_documents(docs.filter(odd), path, 1)
    return searchindex.search_index(f.spark, path, f.tables["benchmark"], query_key="item_id")
