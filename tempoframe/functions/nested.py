"""JSON inside other text, and objects inside JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tempoframe.functions.state import written


def balanced_object(text: str, start: int) -> str | None:
    """The object that opens at the first brace from ``start``, to its closing brace; braces in strings do not count."""
    at = text.find("{", start)
    if at < 0:
        return None
    try:
        _, end = json.JSONDecoder().raw_decode(text, at)
    except ValueError:
        return None
    return text[at:end]


def extract_embedded_json(pages: DataFrame, marker: str, column: str = "html") -> DataFrame:
    """Adds ``payload``: the JSON object after the first ``marker`` in a page; null without marker or whole object.

    Pages are large, so rows go to Python a hundred at a time and not in Arrow batches of thousands.
    """

    @F.udf(StringType(), useArrow=False)
    def payload(html: str | None) -> str | None:
        return None if html is None or (at := html.find(marker)) < 0 else balanced_object(html, at + len(marker))

    return pages.withColumn("payload", payload(column))


def _objects(payloads: DataFrame) -> DataFrame:
    """The root of each payload as a variant; text that is no JSON, or in which an object names a key twice, has none."""
    return payloads.select("match_id", F.lit("$").alias("json_path"), F.try_parse_json("payload").alias("v")).where("v is not null")


#: Levels that one pass over payloads walks.
LEVELS = 4


def walk_raw_events(payloads: DataFrame) -> DataFrame:
    """``match_id``, ``json_path`` and ``event_json`` of every object in a payload that looks like an event: with an ``id`` or ``eventId``, a ``minute`` and an object as ``type``.

    Payloads are variants. A pass goes down ``LEVELS`` levels row by row, writes the events it met and, for the next pass, what is deeper; so a task holds one
    payload at a time and there are a fourth as many passes as payloads are deep. What has no key ``minute`` in its text holds no event and is not entered. ``event_json``
    has sorted keys and no blanks; a payload that is no JSON has no rows.
    """
    step_type, nothing = "struct<step:string,event_json:string,v:variant>", F.lit(None)

    def event(v: Column) -> Column:
        has = lambda key: F.try_variant_get(v, f"$.{key}", "variant").isNotNull()
        is_event = (has("id") | has("eventId")) & has("minute") & F.to_json(F.try_variant_get(v, "$.type", "variant")).startswith("{")
        return F.when(is_event, F.to_json(v))

    def met(step: Column, v: Column) -> Column:
        return F.struct(step.alias("step"), event(v).alias("event_json"), v.alias("v")).cast(step_type)

    own = F.when(F.col("event_json").isNotNull(), F.array(F.struct(F.lit("").alias("step"), F.col("event_json"), nothing.alias("v")).cast(step_type)))
    items = F.transform(F.try_variant_get("v", "$", "array<variant>"), lambda v, i: F.struct(F.concat(F.lit("["), i.cast("string"), F.lit("]")).alias("key"), v.alias("value")))
    fields = F.transform(F.map_entries(F.try_variant_get("v", "$", "map<string,variant>")), lambda e: F.struct(F.concat(F.lit("."), e["key"]).alias("key"), e["value"].alias("value")))
    entered = F.filter(F.coalesce(items, fields, F.array().cast("array<struct<key:string,value:variant>>")), lambda e: F.to_json(e["value"]).rlike(r'(?s)^[{\[].*?"minute":'))
    # What a row gives: itself, if it is an event, and what is in it; rows are chosen in lists, so that no row carries what it came from.
    given = F.concat(F.coalesce(own, F.array().cast(f"array<{step_type}>")), F.transform(entered, lambda e: met(e["key"], e["value"])))
    rows, found = _objects(payloads).select("match_id", "json_path", event(F.col("v")).alias("event_json"), "v"), None
    while rows is not None:
        for _ in range(LEVELS):
            below = rows.select("match_id", "json_path", F.inline_outer(given))  # not inline, which makes lists three times: it asks first whether they are empty
            rows = below.select("match_id", F.concat("json_path", "step").alias("json_path"), "event_json", "v")
        part = written(rows.where("json_path is not null"), "walked")
        events = part.where("event_json is not null").select("match_id", "json_path", "event_json")
        found = events if found is None else found.unionAll(events)
        deeper = part.where("v is not null").select("match_id", "json_path", F.lit(None).cast("string").alias("event_json"), "v")  # its events are found already
        rows = None if deeper.isEmpty() else deeper
    return found
