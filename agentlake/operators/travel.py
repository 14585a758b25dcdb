"""Travel offers: search, quotes, fallback, cost.

A popular route can own a large share of both offers and requests, so requests
never meet raw offers one by one. Offers are first reduced to the cheapest per
search key (partially before the shuffle), and requests join that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.functions.trips import enum_value
from agentlake.operators.paging import skew_join
from agentlake.session import written

# Columns an offer search returns.
FLIGHT_COLUMNS = ("carrier", "flight_number", "from_airport", "to_airport", "ticket_class", "price")
HOTEL_COLUMNS = ("name", "city", "hotel_type", "room_type", "price_per_night")
CAR_COLUMNS = ("provider", "city", "type_of_car", "daily_rate")
FLIGHT_KEY = ("from_airport", "to_airport", "ticket_class")
HOTEL_KEY = ("city", "hotel_type", "room_type")
CAR_KEY = ("city", "type_of_car")

# Times of every stay.
CHECK_IN_TIME = "3:00 pm"
CHECK_OUT_TIME = "11:00 am"

# Fixed value: the question that offers an alternative, around its name.
FALLBACK_QUESTION = (
    "I could not find any {} that match your criteria, but I found ",
    ", would you like to book that instead?",
)

CATEGORIES = ("flights", "accommodation", "car_rental")


def _search(
    offers: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    requests: DataFrame | None,
    criteria: dict[str, str],
) -> DataFrame:
    unknown = set(criteria) - set(key)
    if unknown:
        raise ValueError(f"not a search column: {sorted(unknown)}")
    for column, value in criteria.items():
        offers = offers.filter(F.col(column) == F.lit(value))
    if requests is not None:
        offers = skew_join(offers, requests.select(*key).dropna().distinct(), key, "left_semi")
    return offers.select(*columns)


def search_flights(flights: DataFrame, requests: DataFrame | None = None, **criteria: str) -> DataFrame:
    """Flights equal in every criterion, or in the key of any request.

    An offer carries its own key, so each matching offer is returned once for
    all requests that share the key.
    """
    return _search(flights, FLIGHT_COLUMNS, FLIGHT_KEY, requests, criteria)


def search_hotels(hotels: DataFrame, requests: DataFrame | None = None, **criteria: str) -> DataFrame:
    """Hotels by city, or by city, property type and room type."""
    return _search(hotels, HOTEL_COLUMNS, HOTEL_KEY, requests, criteria)


def search_cars(cars: DataFrame, requests: DataFrame | None = None, **criteria: str) -> DataFrame:
    """Rental cars by city and type."""
    return _search(cars, CAR_COLUMNS, CAR_KEY, requests, criteria)


def cheapest(offers: DataFrame, key: Sequence[str], price: str, ties: Sequence[str]) -> DataFrame:
    """The cheapest offer per key and how many there are: ``key, best, offers``."""
    order = F.struct(price, *ties)
    return offers.groupBy(*key).agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("offers"))


def _kept(best: DataFrame) -> DataFrame:
    """The reduced offers as a table of known size.

    While it is small Catalyst broadcasts it and the requests are not shuffled
    at all; beyond that AQE can split the requests of a popular key.
    """
    return written(best, "best-offers")[0]


def best_flights(flights: DataFrame) -> DataFrame:
    return _kept(cheapest(flights, FLIGHT_KEY, "price", ("carrier", "flight_number", "id")))


def best_hotels(hotels: DataFrame) -> DataFrame:
    return _kept(cheapest(hotels, HOTEL_KEY, "price_per_night", ("name", "id")))


def best_cars(cars: DataFrame) -> DataFrame:
    return _kept(cheapest(cars, CAR_KEY, "daily_rate", ("provider", "id")))


def _leg(prefix: str, best: DataFrame, reverse: bool) -> DataFrame:
    start, end = ("to_airport", "from_airport") if reverse else ("from_airport", "to_airport")
    return best.select(
        F.col(start).alias(f"_{prefix}_from"),
        F.col(end).alias(f"_{prefix}_to"),
        F.col("ticket_class").alias(f"_{prefix}_class"),
        F.col("best").alias(f"_{prefix}"),
    )


def round_trips(flights: DataFrame, trips: DataFrame) -> DataFrame:
    """Cheapest onward and return flight of each trip in the trip's class.

    Output ``trip_id, onward, return`` (structs, NULL when there is no flight)
    and ``total_price``, NULL unless both legs exist.
    """
    best = best_flights(flights)
    asked = trips.select(
        "trip_id", "origin", "destination", "start_date", "end_date",
        enum_value(F.col("travel_class")).alias("_class"),
    )
    out, back = _leg("onward", best, False), _leg("return", best, True)

    def on(leg: DataFrame, prefix: str) -> Column:
        return (
            (asked["origin"] == leg[f"_{prefix}_from"])
            & (asked["destination"] == leg[f"_{prefix}_to"])
            & (asked["_class"] == leg[f"_{prefix}_class"])
        )

    def shown(prefix: str, airport: str, date: str) -> Column:
        offer = F.col(f"_{prefix}")
        return F.when(
            offer.isNotNull(),
            F.struct(
                F.col(airport).alias("airport"),
                F.col(date).alias("date"),
                offer["carrier"].alias("airline"),
                offer["flight_number"].alias("flight_number"),
                F.col("_class").alias("travel_class"),
                offer["price"].alias("cost"),
            ),
        ).alias(prefix)

    return (
        asked.join(out, on(out, "onward"), "left")
        .join(back, on(back, "return"), "left")
        .select(
            "trip_id",
            shown("onward", "origin", "start_date"),
            shown("return", "destination", "end_date"),
            (F.col("_onward")["price"] + F.col("_return")["price"]).alias("total_price"),
        )
    )


def round_trip_choices(flights: DataFrame, trips: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` cheapest pairs of onward and return flight of each trip.

    Output ``trip_id, rank, onward, return, total_price``; fewer rows where there
    are fewer pairs, none where a leg has no flight. Flights without a price
    take no part. Pairs of equal price are ordered by the onward flight, then
    by the return flight.

    Pair (i, j) of two price-ordered legs comes after every pair that is no
    later in both, so only pairs with i * j <= k can be among the first ``k``. They
    are formed once per route from ``k`` flights of each leg, about k ln k of
    them; trips then look up their route.
    """
    order = Window.partitionBy(*FLIGHT_KEY).orderBy("price", "carrier", "flight_number", "id")
    legs, _, _ = written(
        flights.filter(F.col("price").isNotNull())
        .select(*FLIGHT_KEY, "price", "carrier", "flight_number", "id")
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= k)
        .groupBy(*FLIGHT_KEY)
        .agg(F.sort_array(F.collect_list(F.struct("_place", "price", "carrier", "flight_number"))).alias("_offers")),
        "route-offers",
    )

    def side(start: str, end: str, offers: str) -> DataFrame:
        return legs.select(
            F.col(start).alias("_from"), F.col(end).alias("_to"), F.col("ticket_class").alias("_class"),
            F.col("_offers").alias(offers),
        )

    def paired(out: Column) -> Column:
        partners = F.filter("_back", lambda back: out["_place"] * back["_place"] <= k)
        return F.transform(
            partners,
            lambda back: F.struct(
                (out["price"] + back["price"]).alias("total_price"),
                out["_place"].alias("_first"),
                back["_place"].alias("_second"),
                out.alias("_onward"),
                back.alias("_return"),
            ),
        )

    pairs = F.slice(F.sort_array(F.flatten(F.transform("_out", paired))), 1, k)
    routes, _, _ = written(
        side("from_airport", "to_airport", "_out")
        .join(side("to_airport", "from_airport", "_back"), ["_from", "_to", "_class"])
        .select("_from", "_to", "_class", pairs.alias("_pairs")),
        "route-pairs",
    )
    asked = trips.select(
        "trip_id", "start_date", "end_date",
        F.col("origin").alias("_from"), F.col("destination").alias("_to"),
        enum_value(F.col("travel_class")).alias("_class"),
    )

    def shown(prefix: str, airport: str, date: str) -> Column:
        offer = F.col("_pair")[f"_{prefix}"]
        return F.struct(
            F.col(airport).alias("airport"),
            F.col(date).alias("date"),
            offer["carrier"].alias("airline"),
            offer["flight_number"].alias("flight_number"),
            F.col("_class").alias("travel_class"),
            offer["price"].alias("cost"),
        ).alias(prefix)

    return (
        asked.join(routes, ["_from", "_to", "_class"])
        .select("*", F.posexplode("_pairs").alias("_at", "_pair"))
        .select(
            "trip_id",
            (F.col("_at") + 1).alias("rank"),
            shown("onward", "_from", "start_date"),
            shown("return", "_to", "end_date"),
            F.col("_pair")["total_price"].alias("total_price"),
        )
    )


def _days(first: str, last: str) -> Column:
    return F.datediff(F.col(last).try_cast("date"), F.col(first).try_cast("date"))


def hotel_quote(trips: DataFrame, hotels: DataFrame) -> DataFrame:
    """Cheapest matching stay of each trip: nights times the nightly price."""
    best = best_hotels(hotels)
    asked = trips.select(
        "trip_id",
        "destination",
        enum_value(F.col("accomodation_type")).alias("_type"),
        enum_value(F.col("room_type")).alias("_room"),
        _days("checkin_date", "checkout_date").alias("nights"),
    )
    on = (
        (asked["destination"] == best["city"])
        & (asked["_type"] == best["hotel_type"])
        & (asked["_room"] == best["room_type"])
    )
    return asked.join(best, on, "left").select(
        "trip_id",
        F.col("best")["name"].alias("name"),
        "city",
        "hotel_type",
        "room_type",
        F.col("best")["price_per_night"].alias("price_per_night"),
        F.lit(CHECK_IN_TIME).alias("check_in_time"),
        F.lit(CHECK_OUT_TIME).alias("check_out_time"),
        "nights",
        (F.col("nights") * F.col("best")["price_per_night"]).alias("total_rate_usd"),
    )


def car_quote(trips: DataFrame, cars: DataFrame) -> DataFrame:
    """Cheapest matching car of each trip: rental days times the daily rate."""
    best = best_cars(cars)
    asked = trips.select(
        "trip_id",
        "destination",
        F.col("car_rental_start_date").alias("pickup_date"),
        F.col("car_rental_end_date").alias("return_date"),
        enum_value(F.col("type_of_car")).alias("_car"),
        _days("car_rental_start_date", "car_rental_end_date").alias("days"),
    )
    on = (asked["destination"] == best["city"]) & (asked["_car"] == best["type_of_car"])
    return asked.join(best, on, "left").select(
        "trip_id",
        "pickup_date",
        "return_date",
        F.col("best")["provider"].alias("provider"),
        "city",
        F.col("type_of_car").alias("car_type"),
        "days",
        F.col("best")["daily_rate"].alias("daily_rate"),
        (F.col("days") * F.col("best")["daily_rate"]).alias("price"),
    )


def search_with_fallback(
    requests: DataFrame,
    offers: DataFrame,
    key: Sequence[str],
    relax: Sequence[str],
    price: str,
    ties: Sequence[str],
    noun: str,
) -> DataFrame:
    """Exact search, then a search with the ``relax`` columns left open.

    ``requests`` hold ``request_id`` and the key columns; a request with an
    unknown (NULL) relaxed column is only searched the second way. Output is
    ``request_id, match_kind`` (exact, relaxed, none), ``status, question,
    offers, best`` where ``best`` is the cheapest offer with its relaxed
    columns.
    """
    fixed = [c for c in key if c not in relax]
    exact = _kept(cheapest(offers, key, price, ties))
    shape = F.struct(
        F.col("best")[price].alias(price),
        *[F.col(c).alias(c) for c in relax],
        *[F.col("best")[t].alias(t) for t in ties],
    )
    per_key = exact.select(*key, shape.alias("best"), "offers")
    open_search = _kept(
        per_key.groupBy(*[F.col(c).alias(f"_open_{c}") for c in fixed]).agg(
            F.min("best").alias("_open_best"), F.sum("offers").alias("_open_offers")
        )
    )
    hits = per_key.select(
        *[F.col(c).alias(f"_key_{c}") for c in key],
        F.col("best").alias("_key_best"),
        F.col("offers").alias("_key_offers"),
    )
    joined = requests.join(
        hits, [requests[c] == hits[f"_key_{c}"] for c in key], "left"
    ).join(open_search, [requests[c] == open_search[f"_open_{c}"] for c in fixed], "left")
    kind = (
        F.when(F.col("_key_best").isNotNull(), F.lit("exact"))
        .when(F.col("_open_best").isNotNull(), F.lit("relaxed"))
        .otherwise(F.lit("none"))
    )
    offered = F.concat_ws(" ", *[F.col("_open_best")[c] for c in relax])
    before, after = FALLBACK_QUESTION
    question = F.when(kind == "relaxed", F.concat(F.lit(before.format(noun)), offered, F.lit(after)))
    return joined.select(
        "request_id",
        kind.alias("match_kind"),
        F.when(kind == "exact", F.lit("completed"))
        .when(kind == "relaxed", F.lit("input_required"))
        .otherwise(F.lit("error"))
        .alias("status"),
        question.alias("question"),
        F.coalesce("_key_offers", "_open_offers", F.lit(0)).alias("offers"),
        F.coalesce("_key_best", "_open_best").alias("best"),
    )


def cost_lines(flights: DataFrame, hotels: DataFrame, cars: DataFrame, trips: DataFrame) -> DataFrame:
    """One line per trip and category: ``trip_id, category, quantity, amount``.

    ``amount`` is NULL where nothing could be booked. Trips that do not ask for
    a car have no line for one.
    """
    driving = trips.filter(F.lower(F.trim("is_car_rental_required")) == "yes")
    air = round_trips(flights, trips).select(
        "trip_id", F.lit("flights").alias("category"), F.lit(2).alias("quantity"),
        F.col("total_price").alias("amount"),
    )
    stay = hotel_quote(trips, hotels).select(
        "trip_id", F.lit("accommodation").alias("category"), F.col("nights").alias("quantity"),
        F.col("total_rate_usd").alias("amount"),
    )
    car = car_quote(driving, cars).select(
        "trip_id", F.lit("car_rental").alias("category"), F.col("days").alias("quantity"),
        F.col("price").alias("amount"),
    )
    return air.unionByName(stay).unionByName(car)


def trip_cost(lines: DataFrame, trips: DataFrame) -> DataFrame:
    """Cost summary per trip.

    Totals per category, the grand total, cost per traveller, the budget
    difference (positive = over budget), nights and days, and ``replan``: set
    when a booking failed or the budget does not hold.
    """
    totals = lines.groupBy("trip_id").agg(
        *[
            F.sum(F.when(F.col("category") == c, F.col("amount"))).alias(c)
            for c in CATEGORIES
        ],
        F.sum("amount").alias("grand_total"),
        F.sum(F.when(F.col("category") == "accommodation", F.col("quantity"))).alias("nights"),
        F.sum(F.when(F.col("category") == "car_rental", F.col("quantity"))).alias("days"),
        F.count(F.when(F.col("amount").isNull(), F.lit(1))).alias("failed_bookings"),
    )
    asked = trips.select(
        "trip_id",
        F.col("total_budget").try_cast("double").alias("budget"),
        F.col("no_of_travellers").try_cast("int").alias("travellers"),
    )
    over = F.col("grand_total") - F.col("budget")
    return asked.join(totals, "trip_id", "left").select(
        "trip_id",
        *CATEGORIES,
        "grand_total",
        F.try_divide("grand_total", "travellers").alias("per_person"),
        "budget",
        over.alias("over_budget"),
        "nights",
        "days",
        F.coalesce("failed_bookings", F.lit(0)).alias("failed_bookings"),
        (
            (F.coalesce("failed_bookings", F.lit(0)) > 0) | F.coalesce(over > 0, F.lit(False))
        ).alias("replan"),
    )


def ambiguous_places(airports: DataFrame, trips: DataFrame) -> DataFrame:
    """Trip ends whose city has several airports: ``trip_id, role, city, airports``.

    ``role`` is origin or destination; the answer needed is which airport.
    """
    counted = airports.groupBy("city").agg(F.count_distinct("airport").alias("airports"))
    several, _, _ = written(counted.filter(F.col("airports") > 1), "several-airports")
    ends = trips.select(
        "trip_id",
        F.explode(
            F.create_map(
                F.lit("origin"), F.col("origin"), F.lit("destination"), F.col("destination")
            )
        ).alias("role", "city"),
    )
    return ends.join(several, "city").select("trip_id", "role", "city", "airports")
