from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.functions import trips as columns
from agentlake.operators import travel
from agentlake.operators.sqlgate import check_select, run_select, select_envelope, select_or_error
from agentlake.sources.tables import register_tables

import pytest

TRIP = {
    "total_budget": "5000", "origin": "SFO", "destination": "LHR", "type": "business",
    "start_date": "2025-05-12", "end_date": "2025-05-20", "travel_class": "economy",
    "accomodation_type": "Hotel", "room_type": "Suite", "is_car_rental_required": "Yes",
    "type_of_car": "SUV", "no_of_travellers": "1",
}


def trips(spark, *changes):
    fields = ("trip_id", *columns.TRIP_FIELDS)
    records = []
    for i, change in enumerate(changes or ({},)):
        record = {**TRIP, "trip_id": i, **change}
        records.append(tuple(record.get(f) for f in fields))
    return spark.createDataFrame(records, "trip_id long, " + ", ".join(f"{c} string" for c in columns.TRIP_FIELDS))


def flights(spark):
    return spark.createDataFrame(
        [
            (1, "AA", 10, "SFO", "LHR", "ECONOMY", 500.0),
            (2, "BA", 11, "SFO", "LHR", "ECONOMY", 450.0),
            (3, "AB", 12, "SFO", "LHR", "ECONOMY", 450.0),
            (4, "BA", 13, "LHR", "SFO", "ECONOMY", 520.0),
            (5, "BA", 14, "SFO", "LHR", "FIRST", 3000.0),
        ],
        "id long, carrier string, flight_number int, from_airport string, to_airport string, "
        "ticket_class string, price double",
    )


def hotels(spark):
    return spark.createDataFrame(
        [(1, "Grand", "LHR", "HOTEL", "SUITE", 200.0), (2, "Small", "LHR", "AIRBNB", "SUITE", 90.0)],
        "id long, name string, city string, hotel_type string, room_type string, price_per_night double",
    )


def cars(spark):
    return spark.createDataFrame(
        [(1, "Hz", "LHR", "SUV", 60.0), (2, "Av", "LHR", "SUV", 55.0)],
        "id long, provider string, city string, type_of_car string, daily_rate double",
    )


def test_searches(spark, rows):
    assert travel.search_flights(flights(spark), ticket_class="FIRST").columns == list(travel.FLIGHT_COLUMNS)
    assert travel.search_flights(flights(spark), from_airport="SFO", to_airport="LHR", ticket_class="ECONOMY").count() == 3
    assert rows(travel.search_hotels(hotels(spark), city="LHR"), "name") == [("Grand",), ("Small",)]
    assert travel.search_cars(cars(spark), city="PAR").count() == 0
    with pytest.raises(ValueError):
        travel.search_cars(cars(spark), colour="red")
    asked = spark.createDataFrame([("SFO", "LHR", "FIRST")] * 50, "from_airport string, to_airport string, ticket_class string")
    assert rows(travel.search_flights(flights(spark), asked), "flight_number") == [(14,)]


def test_round_trip_takes_the_cheapest_and_breaks_ties(spark):
    found = {r.trip_id: r for r in travel.round_trips(flights(spark), trips(spark, {}, {"travel_class": "first"})).collect()}
    assert found[0].onward.airline == "AB" and found[0]["return"].flight_number == 13
    assert found[0].total_price == 970.0
    assert found[0].onward.date == "2025-05-12" and found[0]["return"].airport == "LHR"
    assert found[1].onward.cost == 3000.0 and found[1]["return"] is None and found[1].total_price is None


def test_example_trip_cost(spark):
    dated = columns.derive_trip_dates(trips(spark, {}, {"type_of_car": "TRUCK", "total_budget": "100"}, {"no_of_travellers": "0"}))
    lines = travel.cost_lines(flights(spark), hotels(spark), cars(spark), dated)
    cost = {r.trip_id: r for r in travel.trip_cost(lines, dated).collect()}
    assert (cost[0].flights, cost[0].accommodation, cost[0].car_rental) == (970.0, 1600.0, 440.0)
    assert (cost[0].grand_total, cost[0].over_budget, cost[0].replan) == (3010.0, -1990.0, False)
    assert (cost[0].nights, cost[0].days, cost[0].per_person) == (8, 8, 3010.0)
    assert cost[1].replan and cost[1].failed_bookings == 1 and cost[1].car_rental is None
    assert cost[2].per_person is None
    # No car is wanted, so none is paid for or missed.
    no = columns.derive_trip_dates(trips(spark, {"is_car_rental_required": "no", "type_of_car": "TRUCK"}, {"is_car_rental_required": None}))
    walk = travel.trip_cost(travel.cost_lines(flights(spark), hotels(spark), cars(spark), no), no).collect()
    assert {(r.car_rental, r.days, r.failed_bookings, r.grand_total, r.replan) for r in walk} == {(None, None, 0, 2570.0, False)}


def test_quotes(spark):
    dated = columns.derive_trip_dates(trips(spark))
    hotel = travel.hotel_quote(dated, hotels(spark)).first()
    assert (hotel.name, hotel.nights, hotel.total_rate_usd) == ("Grand", 8, 1600.0)
    assert (hotel.check_in_time, hotel.check_out_time) == ("3:00 pm", "11:00 am")
    car = travel.car_quote(dated, cars(spark)).first()
    assert (car.provider, car.days, car.price) == ("Av", 8, 440.0)


def test_fallback(spark):
    requests = spark.createDataFrame(
        [(1, "SFO", "LHR", "ECONOMY"), (2, "SFO", "LHR", "BUSINESS"), (3, "SFO", "PAR", "ECONOMY"), (4, "SFO", "LHR", None)],
        "request_id long, from_airport string, to_airport string, ticket_class string",
    )
    found = travel.search_with_fallback(
        requests, flights(spark), travel.FLIGHT_KEY, ["ticket_class"], "price", ["carrier", "flight_number", "id"], "flights"
    )
    by_id = {r.request_id: r for r in found.collect()}
    assert [by_id[i].match_kind for i in (1, 2, 3, 4)] == ["exact", "relaxed", "none", "relaxed"]
    assert [by_id[i].status for i in (1, 2, 3)] == ["completed", "input_required", "error"]
    assert by_id[1].best.price == 450.0 and by_id[1].offers == 3
    assert by_id[2].best.ticket_class == "ECONOMY" and by_id[2].offers == 4
    assert "ECONOMY" in by_id[2].question


def test_dates_follow_the_trip(spark):
    changed = {"checkin_date": "2025-05-13", "checkout_date": "2025-05-19"}
    dated = columns.derive_trip_dates(trips(spark, changed, {**changed, "start_date": None}))
    found = {r.trip_id: r for r in dated.collect()}
    assert (found[0].checkin_date, found[0].checkout_date) == ("2025-05-12", "2025-05-20")
    assert (found[1].checkin_date, found[1].car_rental_start_date) == ("2025-05-13", None)


def test_open_questions(spark):
    dated = columns.derive_trip_dates(trips(spark, {}, {"origin": None, "room_type": ""}, {"end_date": None}))
    found = {r.trip_id: r for r in columns.next_missing(dated, columns.PLANNER_SLOTS).collect()}
    assert (found[0].missing, found[0].next_slot) == ([], None)
    assert (found[1].missing, found[1].next_slot) == (["origin", "room_type"], "origin")
    assert found[2].missing == ["dates", "stay_dates", "car_dates"]
    assert columns.next_missing(dated, columns.AIR_SLOTS).filter("trip_id = 2").first().next_slot == "dates"


def test_violations(spark):
    made = trips(
        spark,
        {"checkin_date": "2025-05-12", "checkout_date": "2025-05-20"},
        {"checkin_date": "2025-05-10", "checkout_date": "soon", "travel_class": "Premium"},
        {"start_date": "2025-06-01"},
    )
    found = {r.trip_id: r.violations for r in columns.validate_trip(made).collect()}
    assert found[0] == []
    assert found[1] == ["checkout_date unreadable", "checkin_date outside trip", "travel_class unknown"]
    assert found[2] == ["start_date after end_date"]


def test_ambiguous_places(spark, rows):
    airports = spark.createDataFrame([("London", "LHR"), ("London", "LGW"), ("London", "LHR"), ("Oslo", "OSL")], "city string, airport string")
    asked = spark.createDataFrame([(1, "London", "Oslo"), (2, "Oslo", "London"), (3, "Oslo", None)], "trip_id long, origin string, destination string")
    assert rows(travel.ambiguous_places(airports, asked)) == [(1, "origin", "London", 2), (2, "destination", "London", 2)]


def test_sql_gate(spark):
    register_tables(spark, {"hotels_view": hotels(spark)})
    assert run_select(spark, "  select name FROM hotels_view where price_per_night < 100").first().name == "Small"
    for text in (None, "", "   ", "WITH a AS (SELECT 1) SELECT * FROM a", "DROP VIEW hotels_view", "(SELECT 1)"):
        with pytest.raises(ValueError):
            check_select(text)
    rows, error = select_or_error(spark, "SELECT stars FROM hotels_view")
    assert rows is None and error["error"].startswith("Please check your query")
    assert "Please check" not in select_or_error(spark, "SELECT * FROM nowhere")[1]["error"]
    assert select_or_error(spark, "SELECT 1 AS one")[1] is None
    assert "error" in select_or_error(spark, "SELECT FROM WHERE")[1]


def test_round_trip_choices_equal_all_pairs(spark):
    import itertools
    import random

    draw = random.Random(1)
    places, classes = ["SFO", "LHR", "CDG"], ["ECONOMY", "FIRST"]
    table = [
        (i, draw.choice("ABC"), draw.randint(1, 9), *draw.sample(places, 2), draw.choice(classes), draw.choice([None, 10.0, 20.5, 30.25, 41.0]))
        for i in range(120)
    ] + [(500 + i, "HOT", i, "SFO", "LHR", "ECONOMY", float(100 + i % 7)) for i in range(300)]
    offers = spark.createDataFrame(table, flights(spark).schema).repartition(5)
    asked = [("SFO", "LHR", "economy"), ("LHR", "CDG", " First "), ("SFO", "SFO", "economy"), (None, "LHR", "economy"), ("SFO", "LHR", "economy")]
    wanted = trips(spark, *[{"origin": a, "destination": b, "travel_class": c} for a, b, c in asked])
    for k in (1, 5, 40):
        got = {}
        for r in travel.round_trip_choices(offers, wanted, k).orderBy("trip_id", "rank").collect():
            got.setdefault(r.trip_id, []).append((r.total_price, r.onward.airline, r.onward.flight_number, r["return"].airline, r["return"].flight_number))
            assert r["rank"] == len(got[r.trip_id]) and r.onward.date == TRIP["start_date"]
        for trip, (a, b, c) in enumerate(asked):
            kind = c.strip().upper()

            def leg(start, end):
                here = [o for o in table if o[3:6] == (start, end, kind) and o[6] is not None]
                return sorted(here, key=lambda o: (o[6], o[1], o[2], o[0]))

            pairs = itertools.product(enumerate(leg(a, b)), enumerate(leg(b, a)))
            best = sorted(((o[6] + r[6], i, j, o, r) for (i, o), (j, r) in pairs), key=lambda p: p[:3])[:k]
            assert got.get(trip, []) == [(t, o[1], o[2], r[1], r[2]) for t, _, _, o, r in best]


def test_select_envelopes(spark):
    import json

    spark.range(25).selectExpr("id", "id * 2 as twice", "if(id = 3, null, 'x') as x").createOrReplaceTempView("numbers")
    pages = select_envelope(spark, "SELECT id, x, twice, id as `odd name`, -id as twice FROM numbers ORDER BY id DESC", 10).orderBy("page").collect()
    parsed = [json.loads(p.envelope)["results"] for p in pages]
    assert [p.page for p in pages] == [0, 1, 2] and [len(p) for p in parsed] == [10, 10, 5]
    assert [r["id"] for p in parsed for r in p] == list(range(24, -1, -1))
    assert parsed[0][0] == {"id": 24, "x": "x", "odd name": 24, "twice": -24}
    assert "x" not in next(r for p in parsed for r in p if r["id"] == 3)
    empty = select_envelope(spark, "SELECT * FROM numbers WHERE id < 0").collect()
    assert [(p.page, p.envelope) for p in empty] == [(0, '{"results": []}')]
    for wrong in ("SELECT absent FROM numbers", "DROP TABLE numbers", "SELECT FROM WHERE", None):
        only = select_envelope(spark, wrong).collect()
        assert len(only) == 1 and list(json.loads(only[0].envelope)) == ["error"]
