"""Alerts and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.operators.paging import PAGE_ROWS, paged_text, same, skew_join

# Separator of blocks and outcomes of the two forecast steps.
SEPARATOR = "\n---\n"
NO_POINT = "Unable to fetch forecast data for this location."
NO_FORECAST = "Unable to fetch detailed forecast."


def alert_text(properties: str = "properties") -> Column:
    """Labelled lines of one alert held as VARIANT.

    Labels and defaults are fixed values of the text format.
    """

    def shown(key: str, default: str) -> Column:
        value = F.try_variant_get(properties, f"$.{key}", "string")
        return F.coalesce(value, F.lit(default))

    return F.concat(
        F.lit("\nEvent: "), shown("event", "Unknown"),
        F.lit("\nArea: "), shown("areaDesc", "Unknown"),
        F.lit("\nSeverity: "), shown("severity", "Unknown"),
        F.lit("\nDescription: "), shown("description", "No description available"),
        F.lit("\nInstructions: "), shown("instruction", "No specific instructions provided"),
        F.lit("\n"),
    )


def format_alerts(
    features: DataFrame, keys: Sequence[str] = ("state",), seq: str = "seq", page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Alerts of each state in order: ``keys, page, alerts_text``.

    Takes ``read_features`` rows; ``seq`` orders payloads, and features follow
    their place within one. A state that only has
    failed or empty payloads shows the status of the first of them.
    """
    alerts = paged_text(
        features.filter(F.col("status").isNull()), keys, seq, alert_text(), SEPARATOR, "_text", page_rows, ("pos",)
    )
    outcome = features.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min_by("status", seq).alias("_status")
    )
    pairs = {f"_{k}": k for k in keys}
    return outcome.join(alerts, same(outcome, alerts, pairs), "left").select(
        *[F.col(f"_{k}").alias(k) for k in keys],
        F.coalesce("page", F.lit(0)).alias("page"),
        F.coalesce("_text", "_status").alias("alerts_text"),
    )


def period_text(period: Column) -> Column:
    """Four lines of one forecast period; the labels, and None for NULL, are
    fixed values."""

    def shown(name: str) -> Column:
        return F.coalesce(period[name].cast("string"), F.lit("None"))

    return F.concat(
        F.lit("\n"), shown("name"), F.lit(":"),
        F.lit("\nTemperature: "), shown("temperature"),
        F.lit("°"), shown("temperatureUnit"),
        F.lit("\nWind: "), shown("windSpeed"), F.lit(" "), shown("windDirection"),
        F.lit("\nForecast: "), shown("detailedForecast"),
        F.lit("\n"),
    )


def first_periods(forecasts: DataFrame, n: int = 5, periods: str = "periods") -> DataFrame:
    """Replace the period array by ``forecast_text`` of its first ``n``."""
    kept = F.transform(F.slice(periods, 1, n), period_text)
    return forecasts.withColumn("forecast_text", F.array_join(kept, SEPARATOR)).drop(periods)


def first_period_rows(
    periods: DataFrame, keys: Sequence[str], seq: str = "seq", n: int = 5
) -> DataFrame:
    """The same limit when every period is a row of its own.

    The rank is limited before the shuffle, so ``n`` rows per key and task move.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    kept = periods.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    period = F.struct(*[c for c in periods.columns if c not in (*keys, seq)])
    rows = F.sort_array(F.collect_list(F.struct(F.col(seq).alias("seq"), period_text(period).alias("text"))))
    return kept.groupBy(*keys).agg(F.array_join(rows.getField("text"), SEPARATOR).alias("forecast_text"))


def forecast_for_points(points: DataFrame, grid: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Two lookups: point to forecast key to text, each with its own failure.

    ``points(point)``, ``grid(point, forecast_key)``, ``forecasts(forecast_key,
    forecast_text)``; keys are unique in the two looked-up tables.
    """
    keyed = points.join(grid, "point", "left")
    found = skew_join(keyed, forecasts.filter(F.col("forecast_key").isNotNull()), ["forecast_key"], "left")
    text = (
        F.when(F.col("forecast_key").isNull(), F.lit(NO_POINT))
        .when(F.col("forecast_text").isNull(), F.lit(NO_FORECAST))
        .otherwise(F.col("forecast_text"))
    )
    return found.select(*points.columns, "forecast_key", text.alias("forecast_text"))
