"""Columns read from logged model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agentlake.functions.jsontext import bound, is_object, strict_json

# Fence patterns, tried in this order; the dot matches newlines.
FENCES = (
    r"```\n(.*?)\n```",
    r"```json\s*(.*?)\s*```",
    r"```tool_outputs\s*(.*?)\s*```",
)
# Fixed value: optional json tag around an object.
OBJECT_FENCE = r"```(?:json)?\s*(\{.*?\})\s*```"

# Replies used when nothing better is known.
FAILED_TEXT = "Could not complete booking / task. Please try again."
UNABLE_TEXT = "We are unable to process your request at the moment. Please try again."


def extract_fenced(text: Column) -> Column:
    """``struct<fenced, body>``: content of the first fence pattern that matches.

    An empty capture still counts as a match. Without a fence the body is the
    whole text.
    """
    fenced = F.lit(False)
    body = text
    for pattern in reversed(FENCES):
        found = text.rlike("(?s)" + pattern)
        fenced = found | fenced
        body = F.when(found, F.regexp_extract(text, "(?s)" + pattern, 1)).otherwise(body)
    return F.struct(F.coalesce(fenced, F.lit(False)).alias("fenced"), body.alias("body"))


def extract_object(text: Column) -> Column:
    """Second variant: the braces inside an optional json fence, else the text."""
    pattern = "(?s)" + OBJECT_FENCE
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(text)


def _response(kind: str | None, complete: bool, ask: bool, content: Column) -> Column:
    return F.struct(
        F.lit(kind).cast("string").alias("response_type"),
        F.lit(complete).alias("is_task_complete"),
        F.lit(ask).alias("require_user_input"),
        content.cast("string").alias("content"),
    )


def _response_of(fenced: Column, body: Column, value: Column) -> Column:
    """Response for the parts found by ``extract_fenced`` and the parsed body."""
    wants_input = F.coalesce(
        F.try_variant_get(value, "$.status", "string") == "input_required", F.lit(False)
    )
    question = F.try_variant_get(value, "$.question", "variant")
    as_object = (
        F.when(wants_input & question.isNull(), _response("text", True, False, F.lit(FAILED_TEXT)))
        .when(wants_input, _response("text", False, True, question.cast("string")))
        .otherwise(_response("data", True, False, body))
    )
    # A fenced JSON string is unquoted first and then read as JSON once more.
    unquoted = F.try_variant_get(value, "$", "string")
    as_string = F.when(
        strict_json(unquoted).isNotNull(), _response("data", True, False, unquoted)
    ).otherwise(_response("text", True, False, unquoted))
    as_text = _response("text", True, False, body)
    return (
        F.when(fenced & is_object(value), as_object)
        .when(fenced & F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False)), as_string)
        .when(fenced, as_text)
        .when(value.isNotNull(), _response("data", True, False, body))
        .otherwise(as_text)
    )


def normalize_response(text: Column) -> Column:
    """``struct<response_type, is_task_complete, require_user_input, content>``."""
    return bound(
        extract_fenced(text),
        lambda part: bound(
            strict_json(part["body"]), lambda value: _response_of(part["fenced"], part["body"], value)
        ),
    )


def planner_response(status: Column, question: Column, content: Column) -> Column:
    """Planner state to a response; an unknown status has no response type."""
    return (
        F.when(status.isin("input_required", "error"), _response("text", False, True, question))
        .when(status == "completed", _response("data", True, False, content))
        .otherwise(_response(None, False, True, F.lit(UNABLE_TEXT)))
    )
