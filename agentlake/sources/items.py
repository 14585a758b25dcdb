"""List objects and feature collections held as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions.jsontext import bound, strict_json

# Outcomes of a payload that cannot be used.
BAD_JSON = "Failed to parse JSON output from kubectl"
NO_FEATURES = "Unable to fetch alerts or no alerts found."
EMPTY_FEATURES = "No active alerts for this state."


def read_items(
    df: DataFrame, text: str, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split payloads ``{"items": [...]}`` into (items, errors).

    Items are ``keys, pos, item`` with ``item`` VARIANT; errors are
    ``keys, error`` for text that is not one JSON document. A document without
    a list under ``items`` has no items and is no error.
    """
    parsed = df.select(*keys, strict_json(F.col(text)).alias("_doc"))
    items = parsed.select(
        *keys,
        F.posexplode(F.try_variant_get("_doc", "$.items", "array<variant>")).alias("pos", "item"),
    )
    errors = parsed.filter(F.col("_doc").isNull()).select(*keys, F.lit(BAD_JSON).alias("error"))
    return items, errors


def read_features(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Explode GeoJSON payloads: ``keys, status, pos, properties`` (VARIANT).

    A payload without a feature list and one with an empty (or null) list each
    leave one row with their own status; a feature's status is NULL.
    """

    def row(status: Column, pos: Column, properties: Column) -> Column:
        return F.struct(
            status.cast("string").alias("status"),
            pos.cast("int").alias("pos"),
            properties.cast("variant").alias("properties"),
        )

    none = F.lit(None)

    def rows(features: Column) -> Column:
        each = F.transform(
            features, lambda f, i: row(none, i, F.try_variant_get(f, "$.properties", "variant"))
        )
        return (
            F.when(features.isNull(), F.array(row(F.lit(NO_FEATURES), none, none)))
            .when(F.size(features) == 0, F.array(row(F.lit(EMPTY_FEATURES), none, none)))
            .otherwise(each)
        )

    def listed(raw: Column) -> Column:
        empty = F.array().cast("array<variant>")
        return F.when(F.is_variant_null(raw), empty).otherwise(F.try_variant_get(raw, "$", "array<variant>"))

    raw = F.try_variant_get(strict_json(F.col(text)), "$.features", "variant")
    found = bound(bound(raw, listed), rows)
    return df.select(*keys, F.explode(found).alias("_row")).select(*keys, "_row.*")
