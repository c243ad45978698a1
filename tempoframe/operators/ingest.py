"""Nested payloads to tables, schema conformance, cleaning and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT = (
    "struct<id:bigint,eventId:bigint,minute:bigint,second:bigint,teamId:bigint,playerId:bigint,x:double,y:double,endX:double,endY:double,isShot:boolean,"
    "type:struct<value:bigint,displayName:string>,outcomeType:struct<value:bigint,displayName:string>,period:struct<value:bigint,displayName:string>,"
    "qualifiers:array<struct<type:struct<value:bigint,displayName:string>,value:string>>>"
)
SIDE = f"struct<teamId:bigint,name:string,players:array<struct<playerId:bigint,id:bigint,name:string,position:string,isFirstEleven:boolean,minutesPlayed:double,minutes:double>>,incidentEvents:array<{EVENT}>>"
#: A match payload; fields that a payload lacks are null.
PAYLOAD = f"struct<startDate:string,statusCode:string,score:string,ftScore:string,venueName:string,home:{SIDE},away:{SIDE},events:array<{EVENT}>>"


def parsed(payloads: DataFrame) -> DataFrame:
    """``match_id`` and the parsed payload ``p``; text that is no payload gives nulls."""
    return payloads.select("match_id", F.from_json("payload", PAYLOAD).alias("p"))


def flatten_matches(payloads: DataFrame) -> DataFrame:
    """One row per match."""
    return parsed(payloads).select(
        "match_id", F.col("p.startDate").alias("start_date"), F.col("p.statusCode").alias("status_code"), F.col("p.score").alias("score"),
        F.col("p.ftScore").alias("ft_score"), F.col("p.home.teamId").alias("home_team_id"), F.col("p.away.teamId").alias("away_team_id"),
    )


def _sides(payloads: DataFrame) -> DataFrame:
    both = F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"p.{s}").alias("t")) for s in ("home", "away")))
    return parsed(payloads).select("match_id", F.inline(both)).where("t.teamId is not null")


def explode_teams(payloads: DataFrame) -> DataFrame:
    """Home and away rows; a side without a team is left out."""
    return _sides(payloads).select("match_id", "side", F.col("t.teamId").alias("team_id"), F.col("t.name").alias("team_name"))


def explode_players(payloads: DataFrame) -> DataFrame:
    """Lineup rows; the id is ``playerId`` else ``id``, minutes are ``minutesPlayed`` else ``minutes``; of repeats the last stands."""
    rows = _sides(payloads).select("match_id", "side", F.col("t.teamId").alias("team_id"), F.posexplode("t.players").alias("pos", "q"))
    made = rows.select(
        "match_id", "side", "team_id", "pos", F.coalesce("q.playerId", "q.id").alias("player_id"), F.col("q.name").alias("player_name"),
        F.col("q.position").alias("position"), F.coalesce("q.isFirstEleven", F.lit(False)).alias("started"), F.coalesce("q.minutesPlayed", "q.minutes").alias("minutes"),
    ).where("player_id is not null")
    last = F.row_number().over(Window.partitionBy("match_id", "player_id").orderBy(F.col("side"), F.col("pos").desc()))
    return made.withColumn("_n", last).where("_n = 1").drop("_n", "pos", "side")


def explode_events_dedup(payloads: DataFrame) -> DataFrame:
    """Events of the match and then of home and away incidents; of one id (else event id, else content) the first stands."""
    lists = F.array(F.col("p.events"), F.col("p.home.incidentEvents"), F.col("p.away.incidentEvents"))
    rows = parsed(payloads).select("match_id", F.posexplode(lists).alias("source", "es")).select("match_id", "source", F.posexplode("es").alias("pos", "e")).where("e is not null")
    key = F.coalesce(F.concat(F.lit("id:"), F.col("e.id").cast("string")), F.concat(F.lit("event:"), F.col("e.eventId").cast("string")), F.to_json("e"))
    n = F.row_number().over(Window.partitionBy("match_id", "event_key").orderBy("source", "pos"))
    return rows.withColumn("event_key", key).withColumn("_n", n).where("_n = 1").select("match_id", "event_key", "source", "e")


def unpack_coded_fields(events: DataFrame) -> DataFrame:
    """Events (column ``e``) with ``*_value`` and ``*_name`` of coded fields, names in snake case, flags false where absent."""
    coded = {"type": "type", "outcomeType": "outcome", "period": "period"}
    parts = [F.col(f"e.{f}.value").alias(f"{n}_value") for f, n in coded.items()] + [F.col(f"e.{f}.displayName").alias(f"{n}_name") for f, n in coded.items()]
    plain = {"id": "persistent_id", "eventId": "event_id", "minute": "minute", "second": "second", "teamId": "team_id", "playerId": "player_id", "x": "x", "y": "y", "endX": "end_x", "endY": "end_y"}
    return events.select("match_id", *(F.col(f"e.{f}").alias(n) for f, n in plain.items()), *parts, F.coalesce("e.isShot", F.lit(False)).alias("is_shot"), F.col("e.qualifiers").alias("qualifiers"))


def qualifiers_to_map(events: DataFrame, qualifiers: str = "qualifiers") -> DataFrame:
    """Adds ``qualifier_names`` and the map ``qualifier_values`` (``true`` without a value); names keep letters, digits and underscores; of repeats the last stands."""
    clean = F.transform(
        F.filter(F.coalesce(qualifiers, F.expr("array()").cast("array<struct<type:struct<value:bigint,displayName:string>,value:string>>")), lambda q: q["type"]["displayName"].isNotNull()),
        lambda q: F.struct(F.regexp_replace(q["type"]["displayName"], "[^A-Za-z0-9_]", "").alias("k"), F.coalesce(q["value"], F.lit("true")).alias("v")),
    )
    rows = events.withColumn("_q", clean)
    names = F.array_distinct(F.transform("_q", lambda q: q["k"]))
    value = F.transform(names, lambda n: F.struct(n.alias("k"), F.element_at(F.filter("_q", lambda q: q["k"] == n), -1)["v"].alias("v")))
    return rows.withColumns({"qualifier_names": names, "qualifier_values": F.map_from_entries(value)}).drop("_q")


def completed_filter(matches: DataFrame) -> DataFrame:
    """Matches that are over: a final status, or a full-time score that is not blank."""
    return matches.where(F.coalesce(F.col("status_code").isin("6", "FT", "Finished", "finished"), F.lit(False)) | (F.trim(F.coalesce("ft_score", F.lit(""))) != ""))


def conform_schema(df: DataFrame, columns: dict[str, tuple[tuple[str, ...], str, object]]) -> DataFrame:
    """Columns by name from the first candidates that exist, cast without failing, nulls filled with the default (if not None)."""
    out = []
    for name, (candidates, kind, default) in columns.items():
        have = [F.col(c).try_cast(kind) for c in candidates if c in df.columns]
        value = F.coalesce(*have) if have else F.lit(None).cast(kind)
        out.append((F.coalesce(value, F.lit(default).cast(kind)) if default is not None else value).alias(name))
    return df.select(*out)


def stable_event_uid(events: DataFrame, fields: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Adds ``event_uid``: match and persistent id, else a digest of ``fields`` and the row's place among equal ones in its match."""
    place = F.row_number().over(Window.partitionBy("match_id", F.col("persistent_id").isNull()).orderBy(*order))
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in fields), place.cast("string"))
    fallback = F.concat(F.lit("fallback:"), F.md5(text.cast("binary")))
    return events.withColumn("event_uid", F.when(F.col("persistent_id").isNotNull(), F.concat_ws(":", "match_id", "persistent_id")).otherwise(fallback))


def union_by_name_relaxed(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; missing columns are null and numbers widen to the widest type."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def scan_history_dedup(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key, the last by ``order``."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order)))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def extract_page_links(pages: DataFrame) -> DataFrame:
    """Links (``href``) of pages in order, the first of each target on a page."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))
    rows = pages.select("page_id", F.posexplode(found).alias("pos", "href"))
    return rows.groupBy("page_id", "href").agg(F.min("pos").cast("long").alias("pos"))


def normalize_season_label(label: Column) -> Column:
    """``2025``, ``2025/26`` and ``2025_2026`` as ``2025-2026``; other text is null."""
    text = F.trim(label)
    first = F.regexp_extract(text, r"^(\d{4})(?:\s*[/_-]\s*(\d{4}|\d{2}))?$", 1)
    second = F.regexp_extract(text, r"^(\d{4})(?:\s*[/_-]\s*(\d{4}|\d{2}))?$", 2)
    start = first.try_cast("int")
    short = (F.floor(start / 100) * 100 + second.try_cast("int")).cast("int")
    end = F.when(F.length(second) == 4, second.try_cast("int")).when(F.length(second) == 2, F.when(short <= start, short + 100).otherwise(short)).otherwise(start + 1)
    return F.when(first != "", F.concat_ws("-", start.cast("string"), end.cast("string")))


def resolve_alias(rows: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """Adds ``registry_key`` of the alias that equals ``column`` in its letters and digits; of several keys the smallest."""
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    names = registry.select("registry_key", F.explode("aliases").alias("_a")).groupBy(bare(F.col("_a")).alias("_alias")).agg(F.min("registry_key").alias("registry_key"))
    return rows.withColumn("_alias", bare(F.col(column))).join(names, "_alias", "left").drop("_alias")


def clean_valuation_records(records: DataFrame, snapshot: str) -> DataFrame:
    """Valuation records with flags, one per player and date: the latest by source time and place.

    A value is valid if it is positive and shown; a record is terminal at a retired club, or without a shown value of zero; future if dated after ``snapshot``.
    """
    hidden, value = F.col("display") == "-", F.col("market_value")
    rows = records.withColumns(
        {
            "is_value_valid": F.coalesce((value > 0) & ~hidden, F.lit(False)),
            "is_terminal_record": F.coalesce(F.lower(F.trim("club_name")) == "retired", F.lit(False)) | F.coalesce(hidden & (value == 0), F.lit(False)),
            "is_future_dated": F.coalesce(F.col("valuation_date") > F.lit(snapshot).cast("date"), F.lit(False)),
        }
    )
    rows = rows.withColumn("is_valid_for_model", F.col("is_value_valid") & ~F.col("is_terminal_record") & ~F.col("is_future_dated"))
    n = F.row_number().over(Window.partitionBy("player_id", "valuation_date").orderBy(F.coalesce("source_timestamp", F.lit(-1)).desc(), F.col("list_index").desc()))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def quality_issue_rows(roster: DataFrame, records: DataFrame) -> DataFrame:
    """Issues: records that repeat a player and date, players without records, and records of players who are not in the roster."""
    many = records.groupBy("player_id", "valuation_date").count().where("count > 1")
    parts = [
        many.select(F.lit("duplicate_record").alias("issue_type"), F.lit("warning").alias("severity"), "player_id", F.col("valuation_date").cast("string").alias("key")),
        roster.join(records, "player_id", "left_anti").select(F.lit("missing_document").alias("issue_type"), F.lit("warning").alias("severity"), "player_id", F.lit(None).cast("string").alias("key")),
        records.join(roster, "player_id", "left_anti").select("player_id").distinct().select(F.lit("not_in_roster").alias("issue_type"), F.lit("error").alias("severity"), "player_id", F.lit(None).cast("string").alias("key")),
    ]
    return union_by_name_relaxed(parts)


def event_quality_checks(events: DataFrame) -> DataFrame:
    """Checks of events as rows of name, severity, count and outcome, by match, from one aggregate pass."""
    out = lambda c: F.coalesce(~F.col(c).between(0, 100), F.lit(False))
    sums = events.groupBy("match_id").agg(
        (F.count("event_id") - F.count_distinct("event_id")).alias("d"), F.count_if(out("x") | out("y")).alias("r"),
        F.count_if(F.col("type_name") == "Pass").alias("p"), F.count_if(F.col("is_shot") == 1).alias("s"), F.count_if(F.col("event_id").isNull()).alias("n"),
    )
    check = lambda name, severity, c, ok: F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col(c).cast("long").alias("n"), ok.alias("passed"))
    return sums.select("match_id", F.inline(F.array(
        check("unique_events", "error", "d", F.col("d") == 0), check("coordinate_range", "error", "r", F.col("r") == 0), check("has_passes", "error", "p", F.col("p") > 0),
        check("has_shots", "warning", "s", F.col("s") > 0), check("id_coverage", "info", "n", F.col("n") == 0),
    )))
