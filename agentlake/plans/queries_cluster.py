"""Cluster, log and weather queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.fixtures import Fixtures
from agentlake.functions.jsontext import field
from agentlake.operators import cluster, logs, records, rules, waits, weather
from agentlake.operators.lookup import describe_many
from agentlake.plans import diagnosis
from agentlake.plans.catalog import query
from agentlake.session import scratch_path
from agentlake.sources import folders, items, sinks
from agentlake.sources.logs import read_logs as read_log_files
from agentlake.sources.logs import split_logs

_PODS = """pods as (
    select namespace, name as pod_name, any_value(phase) as status,
           coalesce(max_by(cpu, pos) filter (where cpu is not null), 'N/A') as cpu_request,
           coalesce(max_by(coalesce(memory, 'N/A'), pos) filter (where cpu is not null), 'N/A') as memory_request
    from pod_containers group by namespace, name)"""


@query(
    f"with {_PODS} select * from pods",
    ("pod_containers",),
)
def list_pods(f: Fixtures) -> DataFrame:
    return cluster.list_pods(f.pods, None)


@query(
    f"with {_PODS} select * from pods where namespace = 'NATION_4'",
    ("pod_containers",),
)
def list_pods_of_namespace(f: Fixtures) -> DataFrame:
    return cluster.list_pods(f.pods, "NATION_4")


_SERVICES = """services as (
    select namespace, name as service_name,
           case when any_value(deleted) is null then 'Active' else 'Terminating' end as status,
           coalesce(any_value(cluster_ip), 'N/A') as cluster_ip,
           coalesce(string_agg(concat(cast(port as string), '/', protocol), ', ' order by pos)
                    filter (where pos is not null), 'N/A') as ports,
           coalesce(string_agg(cast(node_port as string), ', ' order by pos)
                    filter (where pos is not null and node_port is not null), 'N/A') as node_port,
           coalesce('app=' || any_value(app), 'N/A') as selector
    from service_ports group by namespace, name)"""


@query(f"with {_SERVICES} select * from services", ("service_ports",))
def list_services(f: Fixtures) -> DataFrame:
    return cluster.list_services(f.services, None)


@query(
    f"""with {_SERVICES}
    select service_name as "Service Name", status as "Status", cluster_ip as "Cluster IP", ports as "Ports",
           node_port as "Node Port", selector as "Selector" from services""",
    ("service_ports",),
)
def present_services(f: Fixtures) -> DataFrame:
    return sinks.present(cluster.list_services(f.services, None), sinks.SERVICE_HEADERS)


@query(
    f"""with {_PODS}
    select pod_name, concat('| ', pod_name, ' | ', status, ' | ', cpu_request, ' | ', memory_request, ' |') as row
    from pods""",
    ("pod_containers",),
)
def markdown_pods(f: Fixtures) -> DataFrame:
    rows = sinks.markdown_rows(cluster.list_pods(f.pods, None), sinks.POD_HEADERS)
    return rows.select("pod_name", "row")


@query(
    f"""with {_PODS}
    select concat('NATION_', cast(k as string)) as namespace, 0 as page,
           case when count(pod_name) = 0
                then concat('{{"message":"No pods found in namespace ''NATION_', cast(k as string), '''"}}')
                else concat('{{"pods":[', string_agg(
                    concat('{{"pod_name":"', pod_name, '","status":"', status, '","cpu_request":"', cpu_request,
                           '","memory_request":"', memory_request, '"}}'), ','
                    order by cast(substr(pod_name, 5) as bigint)), ']}}') end as envelope
    from (select n_nationkey as k from nation union all select n_nationkey + 1000 from nation where n_nationkey < 5) t
    left join pods on namespace = concat('NATION_', cast(k as string))
    group by k""",
    ("pod_containers",),
)
def to_envelope(f: Fixtures) -> DataFrame:
    pods = cluster.list_pods(f.pods, None).withColumn("seq", F.substring("pod_name", 5, 20).cast("long"))
    columns = ("pod_name", "status", "cpu_request", "memory_request")
    envelopes = sinks.to_envelope(pods, ["namespace"], "seq", columns, "pods")
    nation = f.tables["nation"].select(F.col("n_nationkey").cast("long").alias("id"))
    absent = nation.filter("id < 5").select((F.col("id") + 1000).alias("id"))
    asked = nation.unionByName(absent).select(F.concat(F.lit("NATION_"), F.col("id").cast("string")).alias("namespace"))
    return sinks.envelopes_for(asked, envelopes, "namespace", "pods")


@query(
    """select namespace, pod, cast(null as varchar) as container,
              case when event_id % 17 <> 0 then round(cast(cpu_m as double) / 1000, 6) end as cpu,
              case when event_id % 17 <> 0 then cast(mem_mi as double) * 1048576 end as memory
    from usage""",
    ("usage",),
)
def parse_usage(f: Fixtures) -> DataFrame:
    return cluster.parse_usage(f.usage_text).withColumn("cpu", F.round("cpu", 6))


@query(
    """select namespace, pod, round(cast(sum(case when event_id % 17 <> 0 then cpu_m end) as double) / 1000, 6) as cpu,
    cast(sum(case when event_id % 17 <> 0 then mem_mi end) as double) * 1048576 as memory,
    count(*) as samples, cast(grouping(namespace, pod) as int) as level
    from usage group by rollup (namespace, pod)""",
    ("usage",),
)
def namespace_usage(f: Fixtures) -> DataFrame:
    return cluster.namespace_usage(cluster.parse_usage(f.usage_text)).withColumn("cpu", F.round("cpu", 6))


@query(
    """select e.* from pod_events e
    where exists (select 1 from pod_containers p where p.namespace = e.namespace and p.name = e.pod)""",
    ("pod_events", "pod_containers"),
)
def pod_events(f: Fixtures) -> DataFrame:
    return cluster.pod_events(f.pod_events, f.pods)


@query(
    "select * from pod_events where namespace = 'NATION_7' and pod = 'pod-7'",
    ("pod_events",),
)
def events_of_pod(f: Fixtures) -> DataFrame:
    return cluster.events_of_pod(f.pod_events, "NATION_7", "pod-7")


@query(
    "select * from log_lines where namespace = 'NATION_7' and pod = 'pod-7' and container = 'c1'",
    ("log_lines",),
)
def pod_logs(f: Fixtures) -> DataFrame:
    return cluster.pod_logs(f.log_lines, "NATION_7", "pod-7", "c1")


# Every second deploy asks for one container, the others for all.
_LOG_REQUESTS = """select namespace, pod, case when event_id % 2 = 0 then 'c1' end as container from deploys"""


@query(
    f"""with asked as ({_LOG_REQUESTS})
    select * from log_lines l where exists (
        select 1 from asked a where a.namespace = l.namespace and a.pod = l.pod
           and (a.container is null or a.container = l.container))""",
    ("log_lines", "deploys"),
)
def requested_logs(f: Fixtures) -> DataFrame:
    asked = f.deploys.select(
        "namespace", "pod", F.when(F.col("event_id") % 2 == 0, F.lit("c1")).alias("container")
    )
    return cluster.requested_logs(f.log_lines, asked)


@query(
    """select s_suppkey, s_name, s_acctbal from supplier
    where exists (select 1 from lineitem where l_suppkey = s_suppkey and l_quantity > 49)"""
)
def describe_objects(f: Fixtures) -> DataFrame:
    wanted = f.tables["lineitem"].filter("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return describe_many(f.tables["supplier"], wanted, ["s_suppkey"]).select("s_suppkey", "s_name", "s_acctbal")


_EVENT_LINE = """concat('- Type: ', coalesce(type, 'Unknown'), ', Reason: ', coalesce(reason, 'Unknown'),
    ', Message: ', coalesce(message, 'No message'), ', Count: ', coalesce(cast(count as string), '0'),
    ', First Timestamp: ', coalesce(first_ts, 'Unknown'), ', Last Timestamp: ', coalesce(last_ts, 'Unknown'))"""


@query(
    f"""select namespace, pod, page, string_agg({_EVENT_LINE}, chr(10) order by seq) as events_text
    from (select *, cast((row_number() over (partition by namespace, pod order by seq) - 1) // 7 as int) as page
          from pod_events)
    group by namespace, pod, page""",
    ("pod_events",),
)
def format_events(f: Fixtures) -> DataFrame:
    return cluster.format_events(f.pod_events, page_rows=7)


@query(
    """select p.namespace, p.name as pod, any_value(p.phase) as details, 0 as page, cast(count(e.seq) as int) as events,
           coalesce(string_agg(coalesce(e.reason, '-'), ',' order by e.seq) filter (where e.seq is not null), '') as reasons
    from pod_containers p left join pod_events e on e.namespace = p.namespace and e.pod = p.name
    where p.pos = 0 group by p.namespace, p.name""",
    ("pod_events", "pod_containers"),
)
def pod_info(f: Fixtures) -> DataFrame:
    pods = f.pods.select("namespace", F.col("name").alias("pod"), F.col("phase").alias("details"))
    info = cluster.pod_info(pods, f.pod_events)
    reasons = F.transform(F.col("events").getField("reason"), lambda r: F.coalesce(r, F.lit("-")))
    return info.select(
        "namespace", "pod", "details", "page", F.size("events").alias("events"),
        F.array_join(reasons, ",").alias("reasons"),
    )


_SEVERITY = r"""case when regexp_matches(line, '^\s+at \S+|^Traceback|^\s*File "') then 'stack_trace'
    when regexp_matches(line, '(?i)\b(error|fatal|exception|panic)\b') then 'error'
    when regexp_matches(line, '(?i)\bwarn(ing)?\b') then 'warning' else 'info' end"""
_TEMPLATE = r"""trim(regexp_replace(regexp_replace(line, '\b0x[0-9a-fA-F]+\b', '<id>', 'g'),
    '[0-9]+(\.[0-9]+)*', '<n>', 'g'))"""
_COUNTED = f"""counted as (
    select namespace, pod, {_SEVERITY} as severity, {_TEMPLATE} as template, count(*) as lines,
           min(line_no) as first_line, max(line_no) as last_line
    from log_lines group by all)"""


@query(f"with {_COUNTED} select * from counted", ("log_lines",))
def log_patterns(f: Fixtures) -> DataFrame:
    return logs.log_patterns(f.log_lines)


@query(
    f"""with {_COUNTED}
    select *, cast(row_number() over (partition by namespace, pod order by lines desc, severity, template) as int)
        as rank
    from counted qualify rank <= 3""",
    ("log_lines",),
)
def log_patterns_top(f: Fixtures) -> DataFrame:
    return logs.log_patterns(f.log_lines, top=3)


_RECORD = "partition by namespace, pod, container order by line_no"
_TRACED = "replace(line, 'Starting container...', 'Traceback (most recent call last):')"


@query(
    f"""with traced as (select namespace, pod, container, line_no, {_TRACED} as line from log_lines),
    kinds as (select *, line like ' %' as inside,
                     case when line like 'Traceback%' then 'trace' when line not like ' %' then 'plain' end as kind
              from traced),
    placed as (select *, row_number() over ({_RECORD}) as place, lag(inside) over ({_RECORD}) as after_inside,
                      last_value(kind ignore nulls) over (
                          {_RECORD} rows between unbounded preceding and 1 preceding) as before
               from kinds),
    headed as (select *, max(case when place = 1 or kind = 'trace' or (kind = 'plain'
                                       and not coalesce(after_inside and before = 'trace', false))
                                  then line_no end) over ({_RECORD}) as record
               from placed),
    told as (select namespace, pod, container, record as first_line, max(line_no) as last_line, count(*) as lines,
                    count(*) filter (inside) as frames, arg_min(line, line_no) as line,
                    arg_max(line, line_no) filter (not inside) as cause
             from headed group by all)
    select namespace, pod, container, first_line, last_line, lines, frames,
           case when frames > 0 then 'stack_trace' else {_SEVERITY} end as severity, line as head, cause
    from told""",
    ("log_lines",),
)
def log_records(f: Fixtures) -> DataFrame:
    return records.log_records(f.log_lines.withColumn("line", F.expr(_TRACED)))


_TOLD = """case when event_type = 'error' then concat('error ', p_type, ' on ', p_name, ' of ', c_mktsegment)
    else concat(event_type, ' of ', p_name, ' ', cast(event_id as string), ' by ', c_mktsegment) end as line"""


@query(
    f"""with told as (select {_TOLD} from events join customer on user_id = c_custkey
                    join part on event_id % 200 + 1 = p_partkey),
    masked as (select {_TEMPLATE} as line, count(*) as n from told group by all),
    w0 as (select string_split(line, ' ') as w, len(w) as size, n from masked),
    w1 as (select *, case when count(distinct w[1]) over (partition by size) > 6 then '<*>' else w[1] end as a from w0),
    w2 as (select *, case when count(distinct w[2]) over (partition by size, a) > 6 then '<*>' else w[2] end as b
           from w1),
    w3 as (select *, case when count(distinct w[3]) over leaf > 6 then '<*>' else w[3] end as c,
                     case when count(distinct w[4]) over leaf > 6 then '<*>' else w[4] end as d,
                     case when count(distinct w[5]) over leaf > 6 then '<*>' else w[5] end as e,
                     case when count(distinct w[6]) over leaf > 6 then '<*>' else w[6] end as f,
                     case when count(distinct w[7]) over leaf > 6 then '<*>' else w[7] end as g
           from w2 window leaf as (partition by size, a, b))
    select concat_ws(' ', a, b, c, d, e, f, g) as template, cast(sum(n) as bigint) as lines, count(*) as variants
    from w3 group by template"""
)
def log_templates(f: Fixtures) -> DataFrame:
    """Lines of events that name a part and a segment; nodes keep up to six words."""
    events = f.tables["events"].join(f.tables["customer"], F.expr("user_id = c_custkey"))
    told = events.join(f.tables["part"], F.expr("event_id % 200 + 1 = p_partkey"))
    return records.log_templates(told.select(F.expr(_TOLD.removesuffix(" as line")).alias("line")), depth=2, max_children=6)


_RULES = """rules(category, pattern, remediation) as (values
    ('ImagePullBackOff', '(?i)ImagePullBackOff|ErrImagePull', 'Correct image name in deployment'),
    ('OOMKilled', '(?i)OOMKilled|out of memory', 'Increase memory limits in resource.limits'),
    ('ApplicationError', '(?i)\\b(error|exception)\\b', 'Check application code for exceptions'))"""


@query(
    f"""with {_RULES}
    select namespace, pod, container, line_no, line, category, remediation
    from log_lines join rules on regexp_matches(line, pattern)""",
    ("log_lines",),
)
def classify_findings(f: Fixtures) -> DataFrame:
    return logs.classify_findings(f.log_lines)


_FINDINGS = f"""{_RULES},
    met as (select namespace, pod, category, remediation, count(*) as n
            from log_lines join rules on regexp_matches(line, pattern) group by all),
    found as (select namespace, pod, string_agg(concat(category, ' (', cast(n as string), '): ', remediation), '; '
                  order by category) as findings
              from met group by namespace, pod)"""


@query(f"with {_FINDINGS} select * from found", ("log_lines",))
def pod_findings(f: Fixtures) -> DataFrame:
    return logs.pod_findings(f.log_lines)


@query(
    f"""with {_FINDINGS},
    told as (select namespace, pod, string_agg({_EVENT_LINE}, chr(10) order by seq) as events_text
             from pod_events group by namespace, pod),
    read as (select namespace, pod, string_agg(line, chr(10) order by line_no) as logs_text
             from log_lines group by namespace, pod),
    asked as (select namespace, name as pod, phase as details,
                     case when phase = 'Failed' and name like '%7' then 'not found' end as error
              from pod_containers where pos = 0),
    told_of as (
    select a.namespace, a.pod, 0 as page, case when error is null then details end as details,
           case when error is null then coalesce(l.logs_text, 'No logs available') end as logs,
           case when error is null then
                case when a.pod like '%9' then 'Log analysis failed' else coalesce(f.findings, 'No analysis available') end
                end as findings,
           case when error is null then coalesce(t.events_text, 'No events found') end as events_text,
           case when error is not null then concat('Failed to get pod info: ', error) end as error
    from asked a
    left join found f on f.namespace = a.namespace and f.pod = a.pod
    left join told t on t.namespace = a.namespace and t.pod = a.pod
    left join read l on l.namespace = a.namespace and l.pod = a.pod)
    select *, case when error is null then concat('Pod ', pod, ' in namespace ', namespace, chr(10),
                'Details: ', details, chr(10), 'Findings: ', findings, chr(10),
                'Events:', chr(10), events_text, chr(10), 'Logs:', chr(10), logs) end as report
    from told_of""",
    ("pod_containers", "pod_events", "log_lines"),
)
def troubleshoot(f: Fixtures) -> DataFrame:
    pods = f.pods.select(
        "namespace",
        F.col("name").alias("pod"),
        F.col("phase").alias("details"),
        F.when((F.col("phase") == "Failed") & F.col("name").endswith("7"), F.lit("not found")).alias("error"),
    )
    result = diagnosis.diagnose(pods, f.pod_events, f.log_lines, failed=pods.filter(F.col("pod").endswith("9")))
    artifact = F.try_element_at(F.col("result.artifacts"), F.lit("report"))
    return result.withColumn("report", artifact).drop("result")


@query(
    """with lines as (
        select doc_id, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) as line,
               generate_subscripts(string_split(regexp_replace(text, '\\n$', ''), chr(10)), 1) as line_no
        from documents where text <> '')
    select doc_id, line_no, regexp_replace(line, '\\r$', '') as line from lines"""
)
def split_log_texts(f: Fixtures) -> DataFrame:
    return split_logs(f.tables["documents"], ["doc_id"], "text")


@query("select namespace, line from log_lines", ("log_lines",))
def read_logs(f: Fixtures) -> DataFrame:
    """Write the lines as text files per namespace, then scan the files."""
    path = scratch_path(f.spark, "logs")
    f.log_lines.select("namespace", F.col("line").alias("value")).write.partitionBy("namespace").text(path)
    # The folder names only the namespace.
    found = read_log_files(f.spark, path, r"namespace=(([^/]+))/()[^/]+$")
    return found.select("namespace", "line")


@query(
    """select event_id as payload_id, 0 as pos, 'Warning' as type, event_type as reason,
           concat('pod-', cast(user_id as string)) as object, cast(event_id % 9 as int) as count,
           cast(null as string) as error
    from events where event_id % 5 = 0
    union all
    select event_id, 1, 'Normal', 'none', 'Unknown', 0, null from events where event_id % 5 = 0
    union all
    select event_id, 0, 'Unknown', event_type, 'Unknown', 0, null from events where event_id % 5 = 1
    union all
    select event_id, null, null, null, null, null, 'Failed to parse JSON output from kubectl'
    from events where event_id % 5 in (3, 4)"""
)
def read_items(f: Fixtures) -> DataFrame:
    found, errors = items.read_items(f.event_payloads, "text", ["payload_id"])

    def shown(path: str, default: str, kind: str = "string"):
        return field(F.col("item"), path, default, kind)

    rows = found.select(
        "payload_id",
        "pos",
        shown("$.type", "Unknown").alias("type"),
        # The key is there but null: strict reading keeps NULL.
        F.coalesce(field(F.col("item"), "$.reason", "Unknown", strict_missing=True), F.lit("none")).alias("reason"),
        shown("$.involvedObject.name", "Unknown").alias("object"),
        shown("$.count", "0", "int").alias("count"),
        F.lit(None).cast("string").alias("error"),
    )
    return rows.unionByName(errors, allowMissingColumns=True)


@query(
    """select n_name as state, event_id as seq,
           case when user_id % 25 < 3 then 'No active alerts for this state.'
                when user_id % 25 = 3 then 'Unable to fetch alerts or no alerts found.' end as status,
           case when user_id % 25 > 3 then 0 end as pos,
           case when user_id % 25 > 3 then event_type end as event
    from events join nation on user_id % 25 = n_nationkey"""
)
def read_features(f: Fixtures) -> DataFrame:
    features = items.read_features(f.alert_payloads, "text", ["state", "seq"])
    return features.select(
        "state", "seq", "status", "pos", F.try_variant_get("properties", "$.event", "string").alias("event")
    )


@query(
    """select n_name as state, 0 as page,
           case when any_value(user_id % 25) < 3 then 'No active alerts for this state.'
                when any_value(user_id % 25) = 3 then 'Unable to fetch alerts or no alerts found.'
                else string_agg(concat(chr(10), 'Event: ', event_type, chr(10), 'Area: ',
                    case when event_id % 3 = 0 then 'Unknown' else concat('area ', cast(event_id % 40 as string)) end,
                    chr(10), 'Severity: ', case when event_id % 3 = 0 then 'Unknown' else 'Severe' end,
                    chr(10), 'Description: ',
                    case when event_id % 3 = 0 then 'No description available'
                         else concat('d', cast(event_id as string)) end,
                    chr(10), 'Instructions: ',
                    case when event_id % 3 = 0 then 'No specific instructions provided' else 'stay in' end,
                    chr(10)), concat(chr(10), '---', chr(10)) order by event_id) end as alerts_text
    from events join nation on user_id % 25 = n_nationkey group by n_name"""
)
def format_alerts(f: Fixtures) -> DataFrame:
    features = items.read_features(f.alert_payloads, "text", ["state", "seq"])
    return weather.format_alerts(features)


_PERIOD = """concat(chr(10), {name}, ':', chr(10), 'Temperature: ', cast(temperature as string), '°',
    "temperatureUnit", chr(10), 'Wind: ', "windSpeed", ' ', "windDirection", chr(10), 'Forecast: ',
    "detailedForecast", chr(10))"""
_DASHES = "concat(chr(10), '---', chr(10))"


@query(
    f"""select seq, string_agg({_PERIOD.format(name="concat(name, '.', cast(i as string))")}, {_DASHES} order by i)
        as forecast_text
    from forecast_periods join range(1, 6) t(i) on i <= seq % 8 + 1 group by seq""",
    ("forecast_periods",),
)
def first_periods(f: Fixtures) -> DataFrame:
    return weather.first_periods(f.forecasts)


_FORECASTS = f"""numbered as (select *, row_number() over (partition by forecast_key order by seq) as place
                  from forecast_periods),
    told as (select forecast_key, string_agg({_PERIOD.format(name="name")}, {_DASHES} order by seq) as forecast_text
             from numbered where place <= 5 group by forecast_key)"""


@query(f"with {_FORECASTS} select * from told", ("forecast_periods",))
def first_period_rows(f: Fixtures) -> DataFrame:
    return weather.first_period_rows(f.forecast_periods, ["forecast_key"])


@query(
    f"""with {_FORECASTS}
    select c_custkey, point, p.forecast_key,
           case when p.forecast_key is null then 'Unable to fetch forecast data for this location.'
                else coalesce(forecast_text, 'Unable to fetch detailed forecast.') end as forecast_text
    from forecast_points p left join told t on t.forecast_key = p.forecast_key""",
    ("forecast_periods", "forecast_points"),
)
def forecast_for_points(f: Fixtures) -> DataFrame:
    grid = f.forecast_points.filter(F.col("forecast_key").isNotNull()).select("point", "forecast_key")
    texts = weather.first_period_rows(f.forecast_periods, ["forecast_key"])
    return weather.forecast_for_points(f.forecast_points.select("c_custkey", "point"), grid, texts)


#: Two days stand for the sixty seconds, since events span a month.
WAIT_SECONDS = 2 * 86_400


@query(
    """select d.namespace, d.pod, d.event_id, d.ts,
           min(s.ts) is not null as crashed, min(s.ts) as crashed_at
    from deploys d left join pod_status s on s.namespace = d.namespace and s.pod = d.pod
         and s.waiting_reason = 'CrashLoopBackOff' and s.ts >= d.ts and s.ts < d.ts + interval 2 day
    group by d.namespace, d.pod, d.event_id, d.ts""",
    ("deploys", "pod_status"),
)
def crashloop_wait(f: Fixtures) -> DataFrame:
    return waits.crashloop_wait(f.pod_status, f.deploys, WAIT_SECONDS).withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    """select event_id, concat(event_type, ' by user-', cast(user_id as varchar), ' of ', cast(event_id % 97 as varchar)) as line,
           c_mktsegment as category
    from events join customer on user_id = c_custkey
    union all
    select event_id, concat(event_type, ' by user-', cast(user_id as varchar), ' of ', cast(event_id % 97 as varchar)), 'failed'
    from events where event_type = 'error' and event_id % 97 = 13"""
)
def match_rules(f: Fixtures) -> DataFrame:
    """A rule per customer, and one for failures, against a line per event."""
    user, place = F.col("user_id").cast("string"), (F.col("event_id") % 97).cast("string")
    line = F.concat("event_type", F.lit(" by user-"), user, F.lit(" of "), place)
    lines = f.tables["events"].select("event_id", line.alias("line"))
    pattern = F.concat(F.lit("by user-"), F.col("c_custkey").cast("string"), F.lit("\\b"))
    named = f.tables["customer"].select(F.col("c_mktsegment").alias("category"), pattern.alias("pattern"))
    failed = f.spark.createDataFrame([("failed", r"(?i)^ERROR .* (of|from) 13$")], "category string, pattern string")
    return rules.match_rules(lines, named.unionByName(failed)).drop("pattern")


_ITEM_FILES = """
    with keyed as (
        select o_orderpriority as namespace, o_orderkey % 10 as digit, o_orderkey // 100000 as block, o_orderkey, o_orderstatus
        from orders)
    select namespace, cast(row_number() over (partition by namespace, digit, block order by o_orderkey) - 1 as int) as pos,
           concat('pod-', cast(o_orderkey as string)) as name, o_orderstatus as phase, cast(null as string) as reject
    from keyed where digit <> 9
    union all
    select distinct on (namespace, digit, block) namespace, null, null, null, 'Failed to parse JSON output from kubectl'
    from keyed where digit = 9"""

ITEM_FILES = {"keys": "namespace string", "glob": "*.txt"}


def _item_rows(documents: DataFrame) -> DataFrame:
    found = folders.items_of(documents, "namespace")
    text = lambda name: F.try_variant_get("item", f"$.{name}", "string").alias(name)
    return found.select("namespace", "pos", text("name"), text("phase"), "reject")


@query(_ITEM_FILES)
def item_folder(f: Fixtures) -> DataFrame:
    """Items of a folder of files, and the files that hold no document."""
    path = scratch_path(f.spark, "items")
    f.item_files(path)
    return _item_rows(folders.read_documents(f.spark, path, **ITEM_FILES))


@query(_ITEM_FILES)
def stream_item_folder(f: Fixtures) -> DataFrame:
    """The same, read as files arrive: the second run takes only those that are new."""
    path, table = scratch_path(f.spark, "items"), scratch_path(f.spark, "item-rows")
    for arrived in ("o_orderkey % 10 in (2, 3, 9)", "not o_orderkey % 10 in (2, 3, 9)"):
        f.item_files(path, arrived)
        rows = folders.append_new(_item_rows(folders.stream_documents(f.spark, path, **ITEM_FILES)), table)
    return rows
