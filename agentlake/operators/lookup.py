"""Registry lookups and point lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.operators.paging import skew_join
from agentlake.sources.cards import CARD_URI_PREFIX


def list_cards(cards: DataFrame) -> DataFrame:
    return cards.select("card_uri")


def get_card(cards: DataFrame, name: str) -> DataFrame:
    """Cards stored under one name; the comparison reaches the scan."""
    return cards.filter(F.col("card_uri") == F.lit(CARD_URI_PREFIX + name)).select("card_uri", "agent_card")


def get_cards(cards: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """Cards for a table of names: ``name, found, agent_card``.

    A name without a card stays, with ``found`` false. A name owning several
    cards gives one row each.
    """
    wanted = names.select(name, F.concat(F.lit(CARD_URI_PREFIX), F.col(name)).alias("_uri"))
    return wanted.join(cards, wanted["_uri"] == cards["card_uri"], "left").select(
        name, F.col("card_uri").isNotNull().alias("found"), "agent_card"
    )


def filter_cards(
    cards: DataFrame, streaming: bool | None = None, tag: str | None = None, card: str = "card"
) -> DataFrame:
    """Cards by capability and skill tag, read from the VARIANT column ``card``.

    Capability flags are the strings ``True`` and ``False``, or JSON booleans.
    """
    result = cards
    if streaming is not None:
        flag = F.lower(F.try_variant_get(card, "$.capabilities.streaming", "string"))
        result = result.filter(flag == F.lit(str(streaming).lower()))
    if tag is not None:
        skills = F.try_variant_get(card, "$.skills", "array<struct<tags:array<string>>>")
        tags = F.flatten(F.array_compact(skills.getField("tags")))
        result = result.filter(F.array_contains(tags, tag))
    return result


def describe(objects: DataFrame, **key: str) -> DataFrame:
    """Rows of one object, by equality on its key columns."""
    for column, value in key.items():
        objects = objects.filter(F.col(column) == F.lit(value))
    return objects


def describe_many(objects: DataFrame, wanted: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of every wanted object, each once however often it is asked for."""
    return skew_join(objects, wanted.select(*key).dropna().distinct(), key, "left_semi")
