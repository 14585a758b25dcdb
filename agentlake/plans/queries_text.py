"""Request and reply queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.fixtures import Fixtures
from agentlake.functions import replies, requests
from agentlake.plans.catalog import query

# First fence pattern that matches, and what it captures.
_FENCED = r"""fenced as (
    select reply_id, text,
           case when regexp_matches(text, '(?s)```\n(.*?)\n```') then 1
                when regexp_matches(text, '(?s)```json\s*(.*?)\s*```') then 2
                when regexp_matches(text, '(?s)```tool_outputs\s*(.*?)\s*```') then 3 else 0 end as fence
    from replies),
    cut as (
    select reply_id, fence,
           case fence when 1 then regexp_extract(text, '(?s)```\n(.*?)\n```', 1)
                      when 2 then regexp_extract(text, '(?s)```json\s*(.*?)\s*```', 1)
                      when 3 then regexp_extract(text, '(?s)```tool_outputs\s*(.*?)\s*```', 1)
                      else text end as body
    from fenced)"""


@query(f"with {_FENCED} select reply_id, fence > 0 as fenced, body from cut", ("replies",))
def extract_fenced(f: Fixtures) -> DataFrame:
    return f.replies.select("reply_id", replies.extract_fenced(F.col("text")).alias("part")).select(
        "reply_id", "part.fenced", "part.body"
    )


@query(
    r"""select reply_id, case when regexp_matches(text, '(?s)```(?:json)?\s*(\{.*?\})\s*```')
        then regexp_extract(text, '(?s)```(?:json)?\s*(\{.*?\})\s*```', 1) else text end as object
    from replies""",
    ("replies",),
)
def extract_object(f: Fixtures) -> DataFrame:
    return f.replies.select("reply_id", replies.extract_object(F.col("text")).alias("object"))


# The expected response of every reply kind, stated per kind.
@query(
    r"""select c_custkey as reply_id,
    case when c_custkey % 16 in (1, 2, 7, 10, 12, 13, 15) then 'data' else 'text' end as response_type,
    c_custkey % 16 <> 0 as is_task_complete, c_custkey % 16 = 0 as require_user_input,
    case c_custkey % 16
        when 0 then concat('Which class, ', c_name, '?')
        when 1 then concat('{"hotel": "', c_name, '", "nights": 3}')
        when 2 then concat('{"car": "', c_name, '"}')
        when 3 then concat('{"broken": "', c_name)
        when 4 then '[1, 2, 3]'
        when 5 then concat('Plain answer for ', c_name)
        when 6 then 'Could not complete booking / task. Please try again.'
        when 7 then concat('{"status": "input_required", "question": "', c_name, '"}')
        when 8 then concat('{"name": "', c_name, '"} trailing')
        when 9 then 'quoted'
        when 10 then '[1, 2]'
        when 11 then ''
        when 12 then '{"bare": 1}'
        when 13 then cast(c_custkey as string)
        when 14 then ''
        else concat('{"status": "completed", "question": "', c_name, '"}') end as content
    from customer"""
)
def normalize_response(f: Fixtures) -> DataFrame:
    response = replies.normalize_response(F.col("text"))
    return f.replies.select("reply_id", response.alias("response")).select("reply_id", "response.*")


@query(
    """select o_orderkey as plan_id,
    case when o_orderstatus = 'P' then null when o_orderstatus = 'F' then 'data' else 'text' end as response_type,
    o_orderstatus = 'F' as is_task_complete, o_orderstatus <> 'F' as require_user_input,
    case o_orderstatus when 'F' then concat('{"tasks": ', cast(o_orderkey as string), '}')
        when 'O' then concat('Which date, ', o_orderpriority, '?')
        else 'We are unable to process your request at the moment. Please try again.' end as content
    from orders"""
)
def planner_response(f: Fixtures) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when((F.col("o_orderstatus") == "O") & (key % 2 == 0), F.lit("input_required"))
        .when(F.col("o_orderstatus") == "O", F.lit("error"))
    )
    response = replies.planner_response(
        status,
        F.concat(F.lit("Which date, "), F.col("o_orderpriority"), F.lit("?")),
        F.concat(F.lit('{"tasks": '), key.cast("string"), F.lit("}")),
    )
    return f.tables["orders"].select(key.alias("plan_id"), response.alias("response")).select("plan_id", "response.*")


# Token rules over lists: the last place of a word that has a next token.
_TOKENS = r"""toks as (
    select request_id, text, lower(text) as low,
           [x for x in string_split_regex(lower(text), '\s+') if x <> ''] as t
    from requests),
    places as (
    select *, len(t) as n,
           list_max([i for i in range(1, len(t)) if t[i] = 'namespace']) as ns_at,
           list_max([i for i in range(1, len(t)) if t[i] = 'pod']) as pod_at,
           list_max([i for i in range(1, len(t)) if t[i] = 'container']) as container_at,
           list_max([i for i in range(1, len(t) - 1) if t[i] = 'the' and t[i + 1] = 'default'
                                                   and t[i + 2] = 'namespace']) as default_at,
           list_max([i for i in range(1, len(t) + 1) if contains(t[i], '-pod') or contains(t[i], '-deployment')])
               as hyphen_at
    from toks),
    entities as (
    select request_id, text, low, t, ns_at, pod_at,
           case when contains(low, 'crashloop-pod') and contains(low, 'default namespace') then 'default'
                when coalesce(default_at, -1) > coalesce(ns_at, -1) then 'default'
                when ns_at is not null then t[ns_at + 1] end as namespace,
           case when hyphen_at is not null then t[hyphen_at]
                when contains(low, 'crashloop-pod') and contains(low, 'default namespace') then 'crashloop-pod'
                when pod_at is not null then t[pod_at + 1] end as pod_name,
           case when container_at is not null then t[container_at + 1] end as container_name
    from places)"""


@query(f"with {_TOKENS} select request_id, namespace, pod_name, container_name from entities", ("requests",))
def extract_entities(f: Fixtures) -> DataFrame:
    entities = requests.extract_entities(F.col("text"))
    return f.requests.select("request_id", entities.alias("entities")).select("request_id", "entities.*")


@query(
    f"""with {_TOKENS},
    judged as (select *, contains(low, 'troubleshoot') and contains(low, 'pod') as meant from entities)
    select request_id,
           case when not meant then 'help' when ns_at is not null and pod_at is not null then 'run' else 'specify' end
               as outcome,
           case when meant and ns_at is not null then t[ns_at + 1] end as namespace,
           case when meant and pod_at is not null then t[pod_at + 1] end as pod_name
    from judged""",
    ("requests",),
)
def extract_troubleshoot(f: Fixtures) -> DataFrame:
    found = requests.extract_troubleshoot(F.col("text"))
    return f.requests.select("request_id", found.alias("found")).select(
        "request_id", "found.outcome", "found.namespace", "found.pod_name"
    )


@query(
    f"""with {_TOKENS},
    ruled as (
        select *, case
            when contains(low, 'provide pod information and logs for crashloop-pod in the default namespace')
                then 'pod_info_and_logs'
            when contains(low, 'pod info') or contains(low, 'get pod') then 'pod_info'
            when contains(low, 'pod logs') or contains(low, 'get logs') then 'pod_logs'
            when contains(low, 'list pods') then 'list_pods'
            when namespace is not null and pod_name is not null then 'pod_info' else 'help' end as intent
        from entities)
    select request_id, intent,
           case when intent = 'help' then 'help' when intent = 'pod_info_and_logs' then 'run'
                when intent = 'list_pods' and namespace is not null then 'run'
                when intent in ('pod_info', 'pod_logs') and namespace is not null and pod_name is not null then 'run'
                else 'specify' end as outcome
    from ruled""",
    ("requests",),
)
def classify_intent(f: Fixtures) -> DataFrame:
    known = f.requests.withColumn("e", requests.extract_entities(F.col("text")))
    intent = requests.classify_intent(F.col("text"), F.col("e.namespace"), F.col("e.pod_name"))
    return known.select("request_id", intent.alias("i")).select("request_id", "i.intent", "i.outcome")


@query(
    """select c_custkey as request_id, c_custkey % 16 in (12, 13, 14) as accepted,
    case c_custkey % 16 when 12 then concat('web-', cast(c_custkey as string))
                        when 13 then concat('api-', cast(c_custkey as string)) end as pod_name,
    case c_custkey % 16 when 12 then concat('ERROR one', chr(10), 'ERROR two')
                        end as logs,
    case c_custkey % 16 when 12 then '' when 13 then 'logs' when 14 then 'pod name, logs' end as missing
    from customer"""
)
def parse_log_request(f: Fixtures) -> DataFrame:
    parsed = requests.parse_log_request(F.col("text"))
    return f.requests.select("request_id", parsed.alias("p")).select(
        "request_id", "p.accepted", "p.pod_name", "p.logs", F.array_join("p.missing", ", ").alias("missing")
    )
