"""JSON text helpers built on VARIANT."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often used.

    Projections alone do not guarantee that: the optimizer may copy a costly
    expression into every place that reads it.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def strict_json(text: Column) -> Column:
    """Parse one JSON document; NULL when anything else surrounds it.

    ``try_parse_json`` ignores what follows a document, so the text is parsed as
    the first of two elements of an array whose second is a mark computed from
    the text. A text that closes the array itself never reaches its own mark.
    """

    def parse(both: Column) -> Column:
        wrapped = F.try_parse_json(F.concat(F.lit("["), both["text"], F.lit(","), both["mark"], F.lit("]")))
        elements = F.try_variant_get(wrapped, "$", "array<variant>")
        marked = lambda e: F.try_variant_get(F.try_element_at(e, F.lit(2)), "$", "string") == both["mark"]
        return bound(elements, lambda e: F.when((F.size(e) == 2) & marked(e), F.try_element_at(e, F.lit(1))))

    mark = F.xxhash64(text, F.lit("end")).cast("string")
    return bound(F.struct(text.alias("text"), mark.alias("mark")), parse)


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def field(
    value: Column, path: str, default: str, type_: str = "string", strict_missing: bool = False
) -> Column:
    """Read ``path`` with a default.

    By default the default stands in for a missing key and for an explicit
    ``null``. With ``strict_missing`` an explicit ``null`` stays SQL NULL.
    """
    found = F.try_variant_get(value, path, type_)
    fallback = F.lit(default).cast(type_)
    if not strict_missing:
        return F.coalesce(found, fallback)
    raw = F.try_variant_get(value, path, "variant")
    return F.when(raw.isNull(), fallback).otherwise(found)
