"""Input tables of the operators, derived from a data folder.

Each flat fixture is one SQL text that Spark and DuckDB both accept, so a check
can start from the same rows. Nested inputs are built from flat fixtures in
Spark. Every fixture covers its base tables completely.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.functions.trips import TRIP_FIELDS
from agentlake.sources.tables import TABLES, read_tables, register_tables

FLIGHTS = """
select l_orderkey * 8 + l_linenumber as id, s_name as carrier, l_linenumber as flight_number,
       f.n_name as from_airport, t.n_name as to_airport,
       case when l_partkey % 25 % 4 = 1 and l_partkey % 2 = 0 then 'ECONOMY'
            when l_partkey % 25 % 4 = 1 then 'BUSINESS'
            when l_partkey % 3 = 0 then 'ECONOMY'
            when l_partkey % 3 = 1 then 'BUSINESS'
            else 'FIRST' end as ticket_class,
       l_extendedprice as price
from lineitem
join supplier on l_suppkey = s_suppkey
join nation f on s_nationkey = f.n_nationkey
join nation t on l_partkey % 25 = t.n_nationkey
"""

HOTELS = """
select p_partkey as id, concat(p_name, ' inn') as name, n_name as city,
       case when p_partkey % 3 = 0 then 'HOTEL'
            when p_partkey % 3 = 1 and p_partkey % 25 % 5 <> 2 then 'AIRBNB'
            else 'PRIVATE_PROPERTY' end as hotel_type,
       case p_size % 4 when 0 then 'STANDARD' when 1 then 'SINGLE' when 2 then 'DOUBLE' else 'SUITE' end
           as room_type,
       p_retailprice as price_per_night
from part join nation on p_partkey % 25 = n_nationkey
"""

CARS = """
select s_suppkey as id, s_name as provider, n_name as city,
       case s_suppkey % 3 when 0 then 'SEDAN' when 1 then 'SUV' else 'TRUCK' end as type_of_car,
       round(abs(s_acctbal) / 100, 2) as daily_rate
from supplier join nation on s_nationkey = n_nationkey
"""

TRIPS = """
select o_orderkey as trip_id,
       case when o_orderkey % 17 = 0 then null
            else cast(cast(o_totalprice as decimal(15, 2)) as string) end as total_budget,
       case when o_orderkey % 17 = 1 then null else a.n_name end as origin,
       case when o_orderkey % 17 = 2 then null else b.n_name end as destination,
       case when o_orderkey % 17 = 3 then null
            when o_orderstatus = 'F' then 'business' else 'leisure' end as type,
       case when o_orderkey % 17 = 4 then null
            else cast(cast(o_orderdate as date) as string) end as start_date,
       case when o_orderkey % 17 = 5 then null
            when o_orderkey % 17 = 6 then 'next week'
            else cast(cast(o_orderdate as date) + cast(o_orderkey % 14 + 1 as int) as string) end as end_date,
       case when o_orderkey % 17 = 7 then null
            when o_orderkey % 4 = 0 then 'business' when o_orderkey % 4 = 1 then 'first'
            else 'economy' end as travel_class,
       case when o_orderkey % 17 = 8 then null
            when o_orderkey % 5 = 0 then 'AirBnB' when o_orderkey % 5 = 1 then 'Private Property'
            when o_orderkey % 5 = 2 then 'Tent' else 'Hotel' end as accomodation_type,
       case when o_orderkey % 17 = 9 then null
            when o_orderkey % 3 = 0 then 'Suite' when o_orderkey % 3 = 1 then 'Double'
            else 'Standard' end as room_type,
       case when o_orderkey % 17 = 10 then null
            when o_orderkey % 2 = 0 then 'Yes' else 'No' end as is_car_rental_required,
       case when o_orderkey % 17 = 11 then null
            when o_orderkey % 6 < 3 then 'SUV' when o_orderkey % 6 = 3 then 'Truck'
            else 'Sedan' end as type_of_car,
       case when o_orderkey % 17 = 12 then null
            else cast(o_orderkey % 4 + 1 as string) end as no_of_travellers,
       case when o_orderkey % 3 = 0 then cast(cast(o_orderdate as date) + 1 as string) end as checkin_date,
       case when o_orderkey % 3 = 1 then cast(cast(o_orderdate as date) + 30 as string) end as checkout_date,
       case when o_orderkey % 5 = 0 then cast(cast(o_orderdate as date) + 2 as string) end
           as car_rental_start_date,
       cast(null as string) as car_rental_end_date
from orders
join nation a on o_custkey % 25 = a.n_nationkey
join nation b on (o_orderkey * 7 + 3) % 25 = b.n_nationkey
"""

AIRPORTS = """
select r_name as city, n_name as airport from nation join region on n_regionkey = r_regionkey
union all
select n_name as city, n_name as airport from nation
"""

# Trips whose ends are cities of AIRPORTS, some with one and some with several.
CITY_TRIPS = """
select o_orderkey as trip_id,
       case when o_orderkey % 3 = 0 then r_name else n_name end as origin,
       case when o_orderkey % 2 = 0 then r_name else n_name end as destination
from orders join nation on o_custkey % 25 = n_nationkey join region on n_regionkey = r_regionkey
"""

# Flat form of the nested pods below, for checks only.
POD_CONTAINERS = """
select n_name as namespace, concat('pod-', cast(o_orderkey as string)) as name,
       case o_orderstatus when 'F' then 'Running' when 'O' then 'Pending' else 'Failed' end as phase,
       pos,
       case when (o_orderkey + pos) % 3 = 0 then null
            else concat(cast((o_orderkey + pos) % 900 + 100 as string), 'm') end as cpu,
       case when (o_orderkey + pos) % 3 in (0, 1) then null
            else concat(cast((o_orderkey * 3 + pos) % 500 + 12 as string), 'Mi') end as memory
from orders join nation on o_custkey % 25 = n_nationkey
cross join (values (0), (1), (2)) as slots(pos)
where pos <= o_orderkey % 3
"""

POD_EVENTS = """
select n_name as namespace, concat('pod-', cast(user_id as string)) as pod, event_id as seq,
       case when event_type = 'error' then 'Warning' else 'Normal' end as type,
       case when event_id % 11 = 0 then null else event_type end as reason,
       case when event_id % 11 = 1 then null else concat('saw ', event_type) end as message,
       case when event_id % 11 = 2 then null
            else cast(regexp_replace(props, '[^0-9]', '', 'g') as int) end as count,
       case when event_id % 11 = 3 then null
            else substr(cast(ts as string), 1, 19) end as first_ts,
       substr(cast(ts as string), 1, 19) as last_ts
from events join nation on user_id % 25 = n_nationkey
"""

LOG_LINES = """
select n_name as namespace, concat('pod-', cast(user_id as string)) as pod,
       concat('c', cast(event_id % 2 as string)) as container, event_id as line_no,
       case event_id % 7
            when 0 then concat('ERROR: Could not connect to database at db-', cast(user_id as string), ':3306')
            when 1 then concat('ERROR: Connection timeout after ', cast(event_id % 90 as string), ' seconds')
            when 2 then 'Starting container...'
            when 3 then concat('WARN: slow request took ', cast(event_id as string), ' ms')
            when 4 then concat('Back-off pulling image, ImagePullBackOff retry ', cast(event_id % 10 as string))
            when 5 then concat('Last state OOMKilled at 0x', md5(cast(event_id as string)))
            else '    at com.example.Main.run(Main.java:42)' end as line
from events join nation on user_id % 25 = n_nationkey
"""

# Flat form of the nested services below, for checks only.
SERVICE_PORTS = """
select s_suppkey, n_name as namespace, s_name as name,
       case when s_suppkey % 4 = 0 then null
            else concat('10.0.', cast(s_suppkey % 256 as string), '.1') end as cluster_ip,
       case when s_suppkey % 6 = 0 then 'deleted' end as deleted,
       pos, 8000 + pos as port, case when pos = 1 then 'UDP' else 'TCP' end as protocol,
       case when (s_suppkey + pos) % 2 = 0 then cast(30000 + s_suppkey % 2000 + pos as int) end as node_port,
       case when s_suppkey % 5 <> 0 then s_name end as app
from supplier join nation on s_nationkey = n_nationkey
left join (values (0), (1)) as slots(pos) on pos < s_suppkey % 3
"""

USAGE = """
select n_name as namespace, concat('pod-', cast(user_id as string)) as pod,
       event_id, event_id % 900 + 50 as cpu_m, event_id % 512 + 16 as mem_mi
from events join nation on user_id % 25 = n_nationkey
"""

# One listing per sample, with its heading.
USAGE_TEXT = """
select namespace, concat('NAME   CPU(cores)   MEMORY(bytes)\n', pod, '   ', 
       case when event_id % 17 = 0 then '<unknown>   <unknown>\n'
            else concat(cast(cpu_m as string), 'm   ', cast(mem_mi as string), 'Mi\n') end) as text
from usage
"""

MESSAGES = """
select user_id as stream_id, event_id as seq,
       case when event_id % 13 = 0 then null
            else concat('ctx-', cast(cast(floor(event_id / 400) as bigint) % 3 as string)) end as context_id,
       concat(event_type, ' ', cast(event_id as string)) as query, event_type = 'purchase' as completed
from events
"""

TASK_ITEMS = """
select user_id as task_id, event_id as seq, event_type as content,
       event_id % 29 = 0 as is_task_complete, event_id % 23 = 0 as require_user_input
from events
"""

STATUS_EVENTS = """
select user_id as task_id, event_id as seq,
       case event_type when 'signup' then 'message' when 'error' then 'input_required'
            when 'purchase' then 'completed' else 'working' end as kind,
       case when event_id % 7 = 0 then null else concat('ctx-', cast(user_id as string)) end as context_id
from events
"""

NODE_UPDATES = """
select user_id as node_id, event_id as seq,
       case when event_id % 5 = 0 then concat('task-', cast(event_id as string)) when event_id % 5 = 1 then '' end
           as task_id,
       case when event_id % 7 = 0 then concat('ctx-', cast(event_id as string)) end as context_id,
       case when event_type = 'error' then null else concat(event_type, ' ', cast(event_id as string)) end as query
from events
"""

NODE_EVENTS = """
select user_id as node_id, event_id as seq, ts,
       case event_type when 'signup' then 'READY' when 'error' then 'PAUSED'
            when 'purchase' then 'COMPLETED' else 'RUNNING' end as state
from events
"""

ARTIFACTS = """
select concat('ctx-', cast(user_id as string)) as context_id, event_id as seq,
       case when event_type in ('view', 'click') then 'status' else 'artifact' end as kind,
       case when event_type = 'signup' then 'PlannerAgent-result'
            else concat(event_type, '-result') end as name,
       props as data
from events
"""

PARTS = """
select user_id as message_id, event_id as seq, 'TravelAgent' as agent_name,
       case when event_type = 'error' then null when event_type = 'view' then ''
            else concat(event_type, ' ', cast(event_id as string)) end as text,
       case when event_type = 'error' then props end as function_response
from events
"""

DEPLOYS = """
select n_name as namespace, concat('pod-', cast(user_id as string)) as pod, event_id, ts
from events join nation on user_id % 25 = n_nationkey where event_type = 'signup'
"""

POD_STATUS = """
select n_name as namespace, concat('pod-', cast(user_id as string)) as pod, ts,
       case when event_type = 'error' then 'CrashLoopBackOff' when event_type = 'view' then 'ContainerCreating' end
           as waiting_reason
from events join nation on user_id % 25 = n_nationkey where event_type <> 'signup'
"""

NODES = """
select p_partkey as id, p_partkey as seq from part
"""

# A graph without cycles and with several paths; ends past the last node dangle.
EDGES = """
select p_partkey as src, p_partkey * 2 + 1 as dst from part
union all
select p_partkey as src, p_partkey * 3 + 2 as dst from part
"""

VALID_EDGES = """
select src, dst from edges join nodes on dst = id
"""

OUTCOMES = """
select event_id % 400 as node_id, event_id as seq,
       case when event_type = 'error' and event_id % 97 = 5 then 'input_required' else 'working' end as state,
       case when event_id % 2 = 0 then null else 'ctx' end as context_id
from events
"""

# Nodes a run is asked to start from.
STARTS = """
select p_partkey as id from part where p_size > 45
"""

# Several workflows over the nodes: a node belongs to one of them.
NODE_ORDER = """
select p_partkey % 40 as workflow_id, p_partkey as id, p_size as level, p_partkey as seq from part
"""

REQUESTS = """
select c_custkey as request_id, case c_custkey % 16
    when 0 then concat('Get pod information for ', lower(c_mktsegment), '-pod in namespace ', n_name)
    when 1 then concat('List pods in namespace ', n_name)
    when 2 then concat('Troubleshoot pod p', cast(c_custkey as string), ' in namespace ', n_name)
    when 3 then 'Show logs for crashloop-pod in the default namespace'
    when 4 then concat('Get  pod logs of web-deployment-', cast(c_custkey as string), ' container main namespace ', n_name)
    when 5 then 'Show pods in the default namespace please'
    when 6 then 'list pods'
    when 7 then concat('Provide pod information and logs for crashloop-pod in the default namespace: ', c_name)
    when 8 then concat('pod logs pod a pod b namespace x namespace ', n_name)
    when 9 then 'What is the weather?'
    when 10 then 'Troubleshoot the pod'
    when 11 then concat(c_name, ' wants pod x in the default namespace')
    when 12 then concat('Analyze logs\nPod: web-', cast(c_custkey as string), '\nLogs: ERROR one\nERROR two\n')
    when 13 then concat('analyze pod logs\npod name: api-', cast(c_custkey as string), ' \nno more')
    when 14 then 'Please analyze logs'
    else concat('Pod: ', c_name, '\nlogs: lost') end as text
from customer join nation on c_nationkey = n_nationkey
"""

REPLIES = """
select c_custkey as reply_id, case c_custkey % 16
    when 0 then concat('Here:\n```\n{"status": "input_required", "question": "Which class, ', c_name, '?"}\n```')
    when 1 then concat('```json\n{"hotel": "', c_name, '", "nights": 3}\n```')
    when 2 then concat('```tool_outputs\n{"car": "', c_name, '"}\n```')
    when 3 then concat('```json\n{"broken": "', c_name, '\n```')
    when 4 then '```json\n[1, 2, 3]\n```'
    when 5 then concat('Plain answer for ', c_name)
    when 6 then '```json\n{"status": "input_required"}\n```'
    when 7 then concat('{"status": "input_required", "question": "', c_name, '"}')
    when 8 then concat('{"name": "', c_name, '"} trailing')
    when 9 then '```json\n"quoted"\n```'
    when 10 then '```json\n"[1, 2]"\n```'
    when 11 then '```\n\n```'
    when 12 then concat('```json {"first": "', c_name, '"}``` and ```\n{"bare": 1}\n```')
    when 13 then cast(c_custkey as string)
    when 14 then ''
    else concat('```json\n{"status": "completed", "question": "', c_name, '"}\n```') end as text
from customer
"""

EVENT_PAYLOADS = """
select event_id as payload_id, case event_id % 5
    when 0 then concat('{"items": [{"type": "Warning", "reason": "', event_type, '", "count": ',
                       cast(event_id % 9 as string), ', "involvedObject": {"name": "pod-',
                       cast(user_id as string), '"}}, {"type": "Normal", "reason": null}]}')
    when 1 then concat('{"items": [{"reason": "', event_type, '", "message": "m', cast(event_id as string), '"}]}')
    when 2 then '{"items": []}'
    when 3 then concat('error from server: ', event_type)
    else '{"kind": "List"} trailing' end as text
from events
"""

ALERT_PAYLOADS = """
select n_name as state, event_id as seq, case
    when user_id % 25 < 3 then '{"features": []}'
    when user_id % 25 = 3 then '{"title": "no list"}'
    when event_id % 3 = 0 then concat('{"features": [{"properties": {"event": "', event_type, '", "severity": null}}]}')
    else concat('{"features": [{"properties": {"event": "', event_type, '", "areaDesc": "area ',
                cast(event_id % 40 as string), '", "severity": "Severe", "description": "d', cast(event_id as string),
                '", "instruction": "stay in"}}]}') end as text
from events join nation on user_id % 25 = n_nationkey
"""

FORECAST_PERIODS = """
select concat('grid-', cast(o_custkey as string)) as forecast_key, o_orderkey as seq,
       concat('Day ', cast(o_orderkey as string)) as name, cast(o_orderkey % 40 as int) as temperature,
       'C' as "temperatureUnit", concat(cast(o_orderkey % 30 as string), ' km/h') as "windSpeed",
       case o_orderkey % 4 when 0 then 'N' when 1 then 'E' when 2 then 'S' else 'W' end as "windDirection",
       o_orderpriority as "detailedForecast"
from orders
"""

FORECAST_ROWS = """
select c_custkey, concat('point-', cast(c_custkey as string)) as point,
       case when c_custkey % 5 = 0 then null
            when c_custkey % 5 = 1 then concat('lost-', cast(c_custkey as string))
            else concat('grid-', cast(c_custkey as string)) end as forecast_key
from customer
"""

CARD_TEXTS = """
select distinct concat('resource://agent_cards/', lower(replace(p_brand, '#', '_')), '_', lower(p_type)) as card_uri,
       concat('{"name": "', p_brand, ' agent", "capabilities": {"streaming": "',
              case when p_type in ('ECONOMY', 'PROMO') then 'True' else 'False' end,
              '"}, "skills": [{"id": "s", "tags": ["', lower(p_type), '", "', lower(p_brand), '"]}]}') as agent_card
from part
"""

CARD_TASKS = """
select p_partkey as task_id, concat('Find ', p_name, ' of type ', p_type, ' from ', p_brand) as description
from part
"""

SQL = {
    "flights": FLIGHTS,
    "hotels": HOTELS,
    "cars": CARS,
    "trips": TRIPS,
    "airports": AIRPORTS,
    "city_trips": CITY_TRIPS,
    "pod_containers": POD_CONTAINERS,
    "pod_events": POD_EVENTS,
    "log_lines": LOG_LINES,
    "service_ports": SERVICE_PORTS,
    "usage": USAGE,
    "usage_text": USAGE_TEXT,
    "messages": MESSAGES,
    "task_items": TASK_ITEMS,
    "status_events": STATUS_EVENTS,
    "node_updates": NODE_UPDATES,
    "node_events": NODE_EVENTS,
    "artifacts": ARTIFACTS,
    "parts": PARTS,
    "deploys": DEPLOYS,
    "pod_status": POD_STATUS,
    "nodes": NODES,
    "edges": EDGES,
    "valid_edges": VALID_EDGES,
    "starts": STARTS,
    "outcomes": OUTCOMES,
    "node_order": NODE_ORDER,
    "requests": REQUESTS,
    "replies": REPLIES,
    "event_payloads": EVENT_PAYLOADS,
    "alert_payloads": ALERT_PAYLOADS,
    "forecast_periods": FORECAST_PERIODS,
    "forecast_points": FORECAST_ROWS,
    "card_texts": CARD_TEXTS,
    "card_tasks": CARD_TASKS,
}

# Fixtures that are read from other fixtures.
NEEDS = {"usage_text": ("usage",), "valid_edges": ("edges", "nodes")}


def with_clause(*names: str, recursive: bool = False) -> str:
    """``WITH`` list that defines the fixtures and what they need."""
    wanted: list[str] = []
    for name in names:
        for each in (*NEEDS.get(name, ()), name):
            if each not in wanted:
                wanted.append(each)
    return ("with recursive " if recursive else "with ") + ",\n".join(f"{each} as ({SQL[each].strip()})" for each in wanted)


def oracle(body: str, *names: str) -> str:
    """Check query over fixtures, for DuckDB."""
    for start in ("with recursive ", "with "):
        if body.startswith(start):
            return with_clause(*names, recursive="recursive" in start) + ",\n" + body[len(start) :]
    return with_clause(*names) + "\n" + body


def _spark_text(sql: str) -> str:
    """The few spellings that differ: quoted names, regexp flags, new lines."""
    sql = re.sub(r'as "(\w+)"', r"as `\1`", sql)
    return sql.replace(", '', 'g')", ", '')").replace("\n'", "\\n'")


class _Tables(dict):
    """Base tables, opened and registered when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self._spark, self._folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self.update(read_tables(self._spark, self._folder, [name]))
        return self[name]


class Fixtures:
    """Fixtures of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.tables = _Tables(spark, folder)

    def sql(self, text: str) -> DataFrame:
        """Run a statement over base tables of this folder."""
        used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
        register_tables(self.spark, {t: self.tables[t] for t in used})
        return self.spark.sql(_spark_text(text))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SQL:
            raise AttributeError(name)
        return self.sql(f"{with_clause(name)}\nselect * from {name}")

    @property
    def trip_records(self) -> DataFrame:
        return self.trips.select("trip_id", *TRIP_FIELDS)

    @property
    def pods(self) -> DataFrame:
        """Pods with one to three containers, built row by row from orders."""
        orders, nation = self.tables["orders"], self.tables["nation"]
        key = F.col("o_orderkey")

        def container(pos):
            cpu = F.concat(((key + pos) % 900 + 100).cast("string"), F.lit("m"))
            memory = F.concat(((key * 3 + pos) % 500 + 12).cast("string"), F.lit("Mi"))
            kind = (key + pos) % 3
            none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
            requests = (
                F.when(kind == 0, none)
                .when(kind == 1, F.create_map(F.lit("cpu"), cpu))
                .otherwise(F.create_map(F.lit("cpu"), cpu, F.lit("memory"), memory))
            )
            return F.struct(
                F.concat(F.lit("c"), pos.cast("string")).alias("name"), requests.alias("requests")
            )

        return orders.join(nation, orders["o_custkey"] % 25 == nation["n_nationkey"]).select(
            F.col("n_name").alias("namespace"),
            F.concat(F.lit("pod-"), key.cast("string")).alias("name"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Running"))
            .when(F.col("o_orderstatus") == "O", F.lit("Pending"))
            .otherwise(F.lit("Failed"))
            .alias("phase"),
            F.transform(F.sequence(F.lit(0), (key % 3).cast("int")), container).alias("containers"),
        )

    @property
    def services(self) -> DataFrame:
        """Services with none to two ports, built row by row from suppliers."""
        supplier, nation = self.tables["supplier"], self.tables["nation"]
        key = F.col("s_suppkey")

        def port(pos):
            return F.struct(
                (pos + 8000).cast("int").alias("port"),
                F.when(pos == 1, F.lit("UDP")).otherwise(F.lit("TCP")).alias("protocol"),
                F.when((key + pos) % 2 == 0, (key % 2000 + pos + 30000).cast("int")).alias("node_port"),
            )

        ports = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), (key % 3).cast("int")), port)
        return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
            F.col("n_name").alias("namespace"),
            F.col("s_name").alias("name"),
            F.when(key % 4 != 0, F.concat(F.lit("10.0."), (key % 256).cast("string"), F.lit(".1"))).alias("cluster_ip"),
            F.when(key % 6 == 0, F.timestamp_seconds(key)).alias("deletion_timestamp"),
            F.when(key % 3 != 0, ports).alias("ports"),
            F.when(key % 5 != 0, F.create_map(F.lit("app"), F.col("s_name"))).alias("selector"),
        )

    @property
    def plans(self) -> DataFrame:
        """Plans of one to three tasks, built row by row from orders."""
        key = F.col("o_orderkey")

        def task(pos):
            return F.struct(
                (pos + 1).alias("id"),
                F.concat(F.lit("task "), (pos + 1).cast("string"), F.lit(" of "), key.cast("string")).alias("description"),
                F.lit("pending").alias("status"),
            )

        tasks = F.transform(F.sequence(F.lit(0), (key % 3).cast("int")), task)
        return self.tables["orders"].select(key.alias("plan_id"), tasks.alias("tasks"))

    def item_files(self, path: str, where: str = "true") -> None:
        """Add ``{"items": [...]}`` files below ``path``, a folder per namespace.

        A file holds the orders of a priority, a last digit and a range of
        keys, so its size is bounded; those of digit 9 are cut short.
        """
        key = F.col("o_orderkey")
        item = F.struct(key, F.concat(F.lit("pod-"), key.cast("string")).alias("name"), F.col("o_orderstatus").alias("phase"))
        digit = (key % 10).alias("digit")
        listed = (
            self.tables["orders"]
            .filter(where)
            .groupBy(F.col("o_orderpriority").alias("namespace"), digit, F.floor(key / 100_000).alias("block"))
            .agg(F.sort_array(F.collect_list(item)).alias("items"))
        )
        body = F.to_json(F.struct(F.transform("items", lambda i: F.struct(i["name"], i["phase"])).alias("items")))
        cut = F.when(F.col("digit") == 9, F.left(body, F.length(body) - 2)).otherwise(body)
        files = listed.select("namespace", cut.alias("value")).write.mode("append").partitionBy("namespace")
        files.option("maxRecordsPerFile", 1).text(path)

    @property
    def forecasts(self) -> DataFrame:
        """Forecasts whose periods are an array, one per order."""
        period = F.struct(
            F.col("name"),
            F.col("temperature"),
            F.col("temperatureUnit"),
            F.col("windSpeed"),
            F.col("windDirection"),
            F.col("detailedForecast"),
        )
        copies = F.transform(
            F.sequence(F.lit(1), (F.col("seq") % 8 + 1).cast("int")),
            lambda i: period.withField("name", F.concat(F.col("name"), F.lit("."), i.cast("string"))),
        )
        return self.forecast_periods.select("seq", copies.alias("periods"))
