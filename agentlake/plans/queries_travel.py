"""Travel queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.fixtures import Fixtures
from agentlake.functions import trips as trip_columns
from agentlake.functions.template import render_template
from agentlake.operators import travel
from agentlake.operators.sqlgate import run_select
from agentlake.operators.sqlgate import select_envelope as envelope_of
from agentlake.plans.catalog import query
from agentlake.sources.tables import register_tables

# Request keys as the offer tables spell them.
_ENUM = "upper(replace(trim({0}), ' ', '_'))"
_CLASS = _ENUM.format("travel_class")
_TYPE = _ENUM.format("accomodation_type")
_ROOM = _ENUM.format("room_type")
_CAR = _ENUM.format("type_of_car")

# The trip record after its dependent dates are set.
_DATED = """dated as (
    select trip_id, total_budget, origin, destination, type, start_date, end_date, travel_class,
           accomodation_type, room_type, is_car_rental_required, type_of_car, no_of_travellers,
           coalesce(start_date, checkin_date) as checkin_date,
           coalesce(end_date, checkout_date) as checkout_date,
           coalesce(start_date, car_rental_start_date) as car_rental_start_date,
           coalesce(end_date, car_rental_end_date) as car_rental_end_date
    from trips)"""


@query(
    """select carrier, flight_number, from_airport, to_airport, ticket_class, price from flights f
    where exists (select 1 from trips t where t.origin = f.from_airport and t.destination = f.to_airport
                  and upper(t.travel_class) = f.ticket_class)""",
    ("flights", "trips"),
)
def search_flights(f: Fixtures) -> DataFrame:
    requests = f.trips.select(
        F.col("origin").alias("from_airport"),
        F.col("destination").alias("to_airport"),
        trip_columns.enum_value(F.col("travel_class")).alias("ticket_class"),
    )
    return travel.search_flights(f.flights, requests)


@query(
    f"""select name, city, hotel_type, room_type, price_per_night from hotels h
    where exists (select 1 from trips t where t.destination = h.city and {_TYPE} = h.hotel_type
                  and {_ENUM.format('t.room_type')} = h.room_type)""",
    ("hotels", "trips"),
)
def search_hotels(f: Fixtures) -> DataFrame:
    requests = f.trips.select(
        F.col("destination").alias("city"),
        trip_columns.enum_value(F.col("accomodation_type")).alias("hotel_type"),
        trip_columns.enum_value(F.col("room_type")).alias("room_type"),
    )
    return travel.search_hotels(f.hotels, requests)


@query(
    f"""select provider, city, type_of_car, daily_rate from cars c
    where exists (select 1 from trips t where t.destination = c.city
                  and {_ENUM.format('t.type_of_car')} = c.type_of_car)""",
    ("cars", "trips"),
)
def search_cars(f: Fixtures) -> DataFrame:
    requests = f.trips.select(
        F.col("destination").alias("city"), trip_columns.enum_value(F.col("type_of_car")).alias("type_of_car")
    )
    return travel.search_cars(f.cars, requests)


@query(
    """select carrier, flight_number, from_airport, to_airport, ticket_class, price from flights
    where from_airport = 'NATION_3' and to_airport = 'NATION_7' and ticket_class = 'BUSINESS'""",
    ("flights",),
)
def search_one_route(f: Fixtures) -> DataFrame:
    return travel.search_flights(
        f.flights, from_airport="NATION_3", to_airport="NATION_7", ticket_class="BUSINESS"
    )


@query(
    """select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as sum_qty,
    round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue
    from lineitem where l_shipdate <= date '2001-09-02' group by l_returnflag, l_linestatus"""
)
def run_select_sql(f: Fixtures) -> DataFrame:
    register_tables(f.spark, {"lineitem": f.tables["lineitem"]})
    return run_select(
        f.spark,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
        round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
        FROM lineitem WHERE l_shipdate <= date '2001-09-02' GROUP BY l_returnflag, l_linestatus""",
    )


@query(
    """select 'results' as kind, l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as sum_qty
    from lineitem group by l_returnflag, l_linestatus
    union all select 'error', null, null, null, null from range(2)"""
)
def select_envelope(f: Fixtures) -> DataFrame:
    """The rows of one SELECT out of its JSON, and the errors of two other statements."""
    register_tables(f.spark, {"lineitem": f.tables["lineitem"]})
    statements = (
        "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty "
        "FROM lineitem GROUP BY l_returnflag, l_linestatus",
        "SELECT l_absent FROM lineitem",
        "DELETE FROM lineitem",
    )
    answers = [envelope_of(f.spark, statement) for statement in statements]
    row = "struct<l_returnflag:string,l_linestatus:string,n:bigint,sum_qty:double>"
    found = F.from_json("envelope", f"results array<{row}>, error string")
    rows = reduce(DataFrame.unionByName, answers).select(found.alias("a"))
    return rows.select(
        F.when(F.col("a.error").isNotNull(), F.lit("error")).otherwise(F.lit("results")).alias("kind"),
        F.explode_outer("a.results").alias("r"),
    ).select("kind", "r.*")


@query(
    """with best as (
        select *, row_number() over (partition by from_airport, to_airport, ticket_class
                                     order by price, carrier, flight_number, id) as rn from flights),
    one as (select * from best where rn = 1)
    select t.trip_id, o.carrier as onward_airline, o.flight_number as onward_number, o.price as onward_cost,
           case when o.price is not null then t.start_date end as onward_date,
           r.carrier as return_airline, r.flight_number as return_number, r.price as return_cost,
           case when r.price is not null then t.end_date end as return_date,
           round(o.price + r.price, 2) as total_price
    from trips t
    left join one o on o.from_airport = t.origin and o.to_airport = t.destination
         and o.ticket_class = upper(t.travel_class)
    left join one r on r.from_airport = t.destination and r.to_airport = t.origin
         and r.ticket_class = upper(t.travel_class)""",
    ("flights", "trips"),
)
def round_trips(f: Fixtures) -> DataFrame:
    found = travel.round_trips(f.flights, f.trips)
    return found.select(
        "trip_id",
        F.col("onward.airline").alias("onward_airline"),
        F.col("onward.flight_number").alias("onward_number"),
        F.col("onward.cost").alias("onward_cost"),
        F.col("onward.date").alias("onward_date"),
        F.col("return.airline").alias("return_airline"),
        F.col("return.flight_number").alias("return_number"),
        F.col("return.cost").alias("return_cost"),
        F.col("return.date").alias("return_date"),
        F.round("total_price", 2).alias("total_price"),
    )


@query(
    """with offers as (
        select *, row_number() over (partition by from_airport, to_airport, ticket_class
                                     order by price, carrier, flight_number, id) as place from flights),
    near as (select * from offers where place <= 5),
    chosen as (
        select o.from_airport, o.to_airport, o.ticket_class, o.carrier as onward_airline,
               o.flight_number as onward_number, o.price as onward_cost, r.carrier as return_airline,
               r.flight_number as return_number, r.price as return_cost, round(o.price + r.price, 2) as total_price,
               cast(row_number() over (partition by o.from_airport, o.to_airport, o.ticket_class
                                       order by o.price + r.price, o.place, r.place) as int) as rank
        from near o join near r on r.from_airport = o.to_airport and r.to_airport = o.from_airport
             and r.ticket_class = o.ticket_class)
    select trip_id, rank, onward_airline, onward_number, onward_cost, return_airline, return_number, return_cost,
           total_price
    from trips t join chosen c on c.from_airport = t.origin and c.to_airport = t.destination
         and c.ticket_class = upper(t.travel_class) and rank <= 5""",
    ("flights", "trips"),
)
def round_trip_choices(f: Fixtures) -> DataFrame:
    return travel.round_trip_choices(f.flights, f.trips).select(
        "trip_id",
        "rank",
        F.col("onward.airline").alias("onward_airline"),
        F.col("onward.flight_number").alias("onward_number"),
        F.col("onward.cost").alias("onward_cost"),
        F.col("return.airline").alias("return_airline"),
        F.col("return.flight_number").alias("return_number"),
        F.col("return.cost").alias("return_cost"),
        F.round("total_price", 2).alias("total_price"),
    )


_STAY = f"""stay as (
    select d.trip_id, h.name, h.city, h.hotel_type, h.room_type, h.price_per_night,
           cast(date_diff('day', try_cast(checkin_date as date), try_cast(checkout_date as date)) as int) as nights
    from dated d left join (
        select *, row_number() over (partition by city, hotel_type, room_type
                                     order by price_per_night, name, id) as rn from hotels) h
      on h.rn = 1 and h.city = d.destination and h.hotel_type = {_ENUM.format('d.accomodation_type')}
     and h.room_type = {_ENUM.format('d.room_type')})"""
_RENT = f"""rent as (
    select d.trip_id, d.car_rental_start_date as pickup_date, d.car_rental_end_date as return_date,
           c.provider, c.city, c.type_of_car as car_type, c.daily_rate,
           cast(date_diff('day', try_cast(car_rental_start_date as date), try_cast(car_rental_end_date as date)) as int)
               as days
    from dated d left join (
        select *, row_number() over (partition by city, type_of_car order by daily_rate, provider, id) as rn
        from cars) c
      on c.rn = 1 and c.city = d.destination and c.type_of_car = {_ENUM.format('d.type_of_car')})"""


@query(
    f"""with {_DATED}, {_STAY}
    select trip_id, name, city, hotel_type, room_type, price_per_night, '3:00 pm' as check_in_time,
           '11:00 am' as check_out_time, nights, round(nights * price_per_night, 2) as total_rate_usd
    from stay""",
    ("trips", "hotels"),
)
def hotel_quote(f: Fixtures) -> DataFrame:
    quotes = travel.hotel_quote(trip_columns.derive_trip_dates(f.trips), f.hotels)
    return quotes.withColumn("total_rate_usd", F.round("total_rate_usd", 2))


@query(
    f"""with {_DATED}, {_RENT}
    select trip_id, pickup_date, return_date, provider, city, car_type, days, daily_rate,
           round(days * daily_rate, 2) as price
    from rent""",
    ("trips", "cars"),
)
def car_quote(f: Fixtures) -> DataFrame:
    quotes = travel.car_quote(trip_columns.derive_trip_dates(f.trips), f.cars)
    return quotes.withColumn("price", F.round("price", 2))


@query(
    """with asked as (select trip_id as request_id, origin, destination, upper(travel_class) as wanted from trips),
    exact as (select from_airport, to_airport, ticket_class, count(*) as offers, min(price) as price
              from flights group by all),
    ordered as (select *, row_number() over (partition by from_airport, to_airport
                                             order by price, ticket_class, carrier, flight_number, id) as rn
                from flights),
    open_best as (select * from ordered where rn = 1),
    open_count as (select from_airport, to_airport, count(*) as offers from flights group by all)
    select request_id,
           case when e.price is not null then 'exact' when b.price is not null then 'relaxed' else 'none' end
               as match_kind,
           case when e.price is not null then 'completed' when b.price is not null then 'input_required'
                else 'error' end as status,
           case when e.price is null and b.price is not null then
               concat('I could not find any flights that match your criteria, but I found ', b.ticket_class,
                      ', would you like to book that instead?') end as question,
           coalesce(e.offers, o.offers, 0) as offers,
           coalesce(e.price, b.price) as best_price,
           case when e.price is not null then e.ticket_class else b.ticket_class end as best_class
    from asked
    left join exact e on e.from_airport = origin and e.to_airport = destination and e.ticket_class = wanted
    left join open_best b on b.from_airport = origin and b.to_airport = destination
    left join open_count o on o.from_airport = origin and o.to_airport = destination""",
    ("flights", "trips"),
)
def search_with_fallback(f: Fixtures) -> DataFrame:
    requests = f.trips.select(
        F.col("trip_id").alias("request_id"),
        F.col("origin").alias("from_airport"),
        F.col("destination").alias("to_airport"),
        trip_columns.enum_value(F.col("travel_class")).alias("ticket_class"),
    )
    found = travel.search_with_fallback(
        requests,
        f.flights,
        travel.FLIGHT_KEY,
        ["ticket_class"],
        "price",
        ["carrier", "flight_number", "id"],
        "flights",
    )
    return found.select(
        "request_id",
        "match_kind",
        "status",
        "question",
        "offers",
        F.col("best.price").alias("best_price"),
        F.col("best.ticket_class").alias("best_class"),
    )


@query(
    f"""with {_DATED}, {_STAY}, {_RENT},
    best as (select *, row_number() over (partition by from_airport, to_airport, ticket_class
                                          order by price, carrier, flight_number, id) as rn from flights),
    one as (select * from best where rn = 1),
    air as (select t.trip_id, o.price + r.price as amount from trips t
            left join one o on o.from_airport = t.origin and o.to_airport = t.destination
                 and o.ticket_class = upper(t.travel_class)
            left join one r on r.from_airport = t.destination and r.to_airport = t.origin
                 and r.ticket_class = upper(t.travel_class)),
    parts as (
        select d.trip_id, air.amount as flights, nights * price_per_night as accommodation,
               lower(trim(is_car_rental_required)) = 'yes' as drives,
               case when lower(trim(is_car_rental_required)) = 'yes' then days * daily_rate end as car_rental, nights,
               case when lower(trim(is_car_rental_required)) = 'yes' then days end as days,
               try_cast(total_budget as double) as budget, try_cast(no_of_travellers as int) as travellers
        from dated d join air using (trip_id) join stay using (trip_id) join rent using (trip_id)),
    summed as (
        select *, case when flights is null and accommodation is null and car_rental is null then null
                  else coalesce(flights, 0) + coalesce(accommodation, 0) + coalesce(car_rental, 0) end as grand_total,
               cast((flights is null) as bigint) + cast((accommodation is null) as bigint)
                   + cast((coalesce(drives, false) and car_rental is null) as bigint) as failed_bookings
        from parts)
    select trip_id, round(flights, 2) as flights, round(accommodation, 2) as accommodation,
           round(car_rental, 2) as car_rental, round(grand_total, 2) as grand_total,
           round(grand_total / travellers, 6) as per_person, budget,
           round(grand_total - budget, 2) as over_budget, cast(nights as bigint) as nights,
           cast(days as bigint) as days, failed_bookings,
           failed_bookings > 0 or coalesce(grand_total - budget > 0, false) as replan
    from summed""",
    ("flights", "hotels", "cars", "trips"),
)
def trip_cost(f: Fixtures) -> DataFrame:
    trips = trip_columns.derive_trip_dates(f.trips)
    lines = travel.cost_lines(f.flights, f.hotels, f.cars, trips)
    digits = {"flights": 2, "accommodation": 2, "car_rental": 2, "grand_total": 2, "over_budget": 2, "per_person": 6}
    return travel.trip_cost(lines, trips).withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    """with several as (select city, count(distinct airport) as airports from airports group by city
                     having count(distinct airport) > 1)
    select trip_id, 'origin' as role, city, airports from city_trips join several on origin = city
    union all
    select trip_id, 'destination' as role, city, airports from city_trips join several on destination = city""",
    ("airports", "city_trips"),
)
def ambiguous_places(f: Fixtures) -> DataFrame:
    return travel.ambiguous_places(f.airports, f.city_trips)


@query(
    f"""with {_DATED} select * from dated""",
    ("trips",),
)
def derive_trip_dates(f: Fixtures) -> DataFrame:
    return trip_columns.derive_trip_dates(f.trips)


def _open_slots(slots: dict[str, tuple[str, ...]]) -> str:
    parts = []
    for slot, fields in slots.items():
        gap = " or ".join(f"{c} is null or trim({c}) = ''" for c in fields)
        parts.append(f"case when {gap} then '{slot}' end")
    return ", ".join(parts)


def _slot_check() -> str:
    columns = []
    for prefix, slots in _SLOTS.items():
        columns.append(f"concat_ws(',', {_open_slots(slots)}) as {prefix}_missing")
        columns.append(f"coalesce({_open_slots(slots)}) as {prefix}_next")
    return f"with {_DATED} select trip_id, {', '.join(columns)} from dated"


_SLOTS = {
    "planner": trip_columns.PLANNER_SLOTS,
    "air": trip_columns.AIR_SLOTS,
    "hotel": trip_columns.HOTEL_SLOTS,
    "car": trip_columns.CAR_SLOTS,
}


@query(_slot_check(), ("trips",))
def next_missing(f: Fixtures) -> DataFrame:
    trips = trip_columns.derive_trip_dates(f.trips)
    columns = []
    for prefix, slots in _SLOTS.items():
        trips = trip_columns.next_missing(trips, slots)
        trips = trips.withColumn(f"{prefix}_missing", F.array_join("missing", ","))
        trips = trips.withColumnRenamed("next_slot", f"{prefix}_next").drop("missing")
        columns += [f"{prefix}_missing", f"{prefix}_next"]
    return trips.select("trip_id", *columns)


def _violation_check() -> str:
    inner = ("checkin_date", "checkout_date", "car_rental_start_date", "car_rental_end_date")

    def day(column: str) -> str:
        return f"try_cast({column} as date)"

    cases = [
        f"case when {c} is not null and {day(c)} is null then '{c} unreadable' end"
        for c in ("start_date", "end_date", *inner)
    ]
    cases.append(f"case when {day('start_date')} > {day('end_date')} then 'start_date after end_date' end")
    cases += [
        f"case when {day(c)} < {day('start_date')} or {day(c)} > {day('end_date')} then '{c} outside trip' end"
        for c in inner
    ]
    for first, last in (inner[:2], inner[2:]):
        cases.append(f"case when {day(first)} > {day(last)} then '{first} after {last}' end")
    domains = {
        "travel_class": trip_columns.TICKET_CLASSES,
        "accomodation_type": trip_columns.HOTEL_TYPES,
        "room_type": trip_columns.ROOM_TYPES,
        "type_of_car": trip_columns.CAR_TYPES,
    }
    cases += [
        f"case when {_ENUM.format(c)} not in {domain} then '{c} unknown' end" for c, domain in domains.items()
    ]
    return f"select trip_id, concat_ws('; ', {', '.join(cases)}) as violations from trips"


@query(_violation_check(), ("trips",))
def validate_trip(f: Fixtures) -> DataFrame:
    return trip_columns.validate_trip(f.trips).select(
        "trip_id", F.array_join("violations", "; ").alias("violations")
    )


@query(
    """select trip_id,
    replace(replace(replace('Trip {TRIP} to {PLACE} ({CLASS})', '{TRIP}', concat('#', cast(trip_id as string), ' {CLASS}')),
            '{PLACE}', coalesce(destination, '')), '{CLASS}', coalesce(travel_class, '')) as rendered
    from trips""",
    ("trips",),
)
def render_template_text(f: Fixtures) -> DataFrame:
    named = f.trips.withColumn(
        "label", F.concat(F.lit("#"), F.col("trip_id").cast("string"), F.lit(" {CLASS}"))
    )
    places = {"TRIP": "label", "PLACE": "destination", "CLASS": "travel_class"}
    return render_template(named, "Trip {TRIP} to {PLACE} ({CLASS})", places).select("trip_id", "rendered")
