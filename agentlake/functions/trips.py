"""Columns of the trip record: derived dates, open questions, violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of the trip record, all nullable strings.
TRIP_FIELDS = (
    "total_budget",
    "origin",
    "destination",
    "type",
    "start_date",
    "end_date",
    "travel_class",
    "accomodation_type",
    "room_type",
    "is_car_rental_required",
    "type_of_car",
    "no_of_travellers",
    "checkin_date",
    "checkout_date",
    "car_rental_start_date",
    "car_rental_end_date",
)

# Questions in the order they are asked, and the fields that
# must be known before each counts as answered.
PLANNER_SLOTS = {
    "origin": ("origin",),
    "destination": ("destination",),
    "dates": ("start_date", "end_date"),
    "budget": ("total_budget",),
    "type_of_travel": ("type",),
    "no_of_travellers": ("no_of_travellers",),
    "class": ("travel_class",),
    "stay_dates": ("checkin_date", "checkout_date"),
    "property_type": ("accomodation_type",),
    "room_type": ("room_type",),
    "car_rental_requirement": ("is_car_rental_required",),
    "type_of_car": ("type_of_car",),
    "car_dates": ("car_rental_start_date", "car_rental_end_date"),
}
AIR_SLOTS = {
    "origin": ("origin",),
    "destination": ("destination",),
    "dates": ("start_date", "end_date"),
    "class": ("travel_class",),
}
HOTEL_SLOTS = {
    "city": ("destination",),
    "dates": ("checkin_date", "checkout_date"),
    "property_type": ("accomodation_type",),
    "room_type": ("room_type",),
}
CAR_SLOTS = {
    "city": ("destination",),
    "dates": ("car_rental_start_date", "car_rental_end_date"),
    "type_of_car": ("type_of_car",),
}

# Enumerations of the offer tables.
TICKET_CLASSES = ("ECONOMY", "BUSINESS", "FIRST")
HOTEL_TYPES = ("HOTEL", "AIRBNB", "PRIVATE_PROPERTY")
ROOM_TYPES = ("STANDARD", "SINGLE", "DOUBLE", "SUITE")
CAR_TYPES = ("SEDAN", "SUV", "TRUCK")


def enum_value(text: Column) -> Column:
    """Free text to the spelling of the offer tables."""
    return F.upper(F.replace(F.trim(text), F.lit(" "), F.lit("_")))


def derive_trip_dates(trips: DataFrame) -> DataFrame:
    """Stay and car dates follow the trip's dates wherever those are known."""
    sources = {
        "checkin_date": "start_date",
        "checkout_date": "end_date",
        "car_rental_start_date": "start_date",
        "car_rental_end_date": "end_date",
    }
    return trips.withColumns({c: F.coalesce(F.col(src), F.col(c)) for c, src in sources.items()})


def next_missing(trips: DataFrame, slots: dict[str, tuple[str, ...]]) -> DataFrame:
    """Add ``missing`` (open slots in order) and ``next_slot`` (the first one)."""

    def unknown(fields: tuple[str, ...]) -> Column:
        gap = F.lit(False)
        for name in fields:
            gap = gap | F.col(name).isNull() | (F.trim(F.col(name)) == "")
        return gap

    flags = [F.when(unknown(fields), F.lit(slot)) for slot, fields in slots.items()]
    return trips.withColumns(
        {"missing": F.array_compact(F.array(*flags)), "next_slot": F.coalesce(*flags)}
    )


def validate_trip(trips: DataFrame) -> DataFrame:
    """Add ``violations``: dates outside the trip and values outside an enum."""

    def day(name: str) -> Column:
        return F.col(name).try_cast("date")

    def bad_date(name: str) -> Column:
        return F.when(F.col(name).isNotNull() & day(name).isNull(), F.lit(f"{name} unreadable"))

    def outside(name: str) -> Column:
        return F.when(
            ~day(name).between(day("start_date"), day("end_date")), F.lit(f"{name} outside trip")
        )

    def reversed_range(first: str, last: str) -> Column:
        return F.when(day(first) > day(last), F.lit(f"{first} after {last}"))

    def not_in(name: str, domain: tuple[str, ...]) -> Column:
        return F.when(~enum_value(F.col(name)).isin(*domain), F.lit(f"{name} unknown"))

    inner = ("checkin_date", "checkout_date", "car_rental_start_date", "car_rental_end_date")
    checks = [
        *(bad_date(c) for c in ("start_date", "end_date", *inner)),
        reversed_range("start_date", "end_date"),
        *(outside(c) for c in inner),
        reversed_range("checkin_date", "checkout_date"),
        reversed_range("car_rental_start_date", "car_rental_end_date"),
        not_in("travel_class", TICKET_CLASSES),
        not_in("accomodation_type", HOTEL_TYPES),
        not_in("room_type", ROOM_TYPES),
        not_in("type_of_car", CAR_TYPES),
    ]
    return trips.withColumn("violations", F.array_compact(F.array(*checks)))
