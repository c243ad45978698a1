"""Queries over payloads, pages and records, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions import nested as nes
from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.functions.state import shared_path
from tempoframe.operators import ingest as ing
from tempoframe.plans.fixtures import ctes, projected, table
from tempoframe.sources import files as src


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of all matches: every event, each tenth again among home incidents, and the lineups."""
    events = projected(spark, sf_dir, "match_events")
    coded = lambda v, n: F.struct(v.cast("long").alias("value"), n.alias("displayName"))
    quality = F.array(F.struct(coded(F.lit(1), F.col("pass_kind")).alias("type"), F.lit(None).cast("string").alias("value")), F.struct(coded(F.lit(2), F.lit("Zone x")).alias("type"), F.col("body_part").alias("value")))
    e = F.struct(
        F.when(F.col("event_id") % 3 > 0, F.col("event_id")).alias("id"), F.col("event_id").alias("eventId"), F.col("expanded_minute").alias("minute"), F.col("event_second").alias("second"),
        F.col("team_id").cast("long").alias("teamId"), F.col("player_id").alias("playerId"), "x", "y", F.col("end_x").alias("endX"), F.col("end_y").alias("endY"), (F.col("is_shot") == 1).alias("isShot"),
        coded(F.lit(0), F.col("type_name")).alias("type"), coded(F.when(F.col("outcome_name") == "Successful", 1).otherwise(0), F.col("outcome_name")).alias("outcomeType"),
        coded(F.col("period_value"), F.lit("Half")).alias("period"), quality.alias("qualifiers"),
    )
    listed = events.groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct("event_id", e.alias("e")))).alias("es"))
    lines = projected(spark, sf_dir, "player_matches")
    q = F.struct(F.col("player_id").alias("playerId"), F.concat(F.lit("P"), F.col("player_id").cast("string")).alias("name"), F.col("position_code").alias("position"), (F.col("started") == 1).alias("isFirstEleven"), F.col("minutes").alias("minutesPlayed"))
    sides = lines.groupBy("match_id").agg(*(F.sort_array(F.collect_list(F.when(F.col("team_id") == t, q))).alias(s) for s, t in (("h", 1), ("a", 2))))
    just = lambda c: F.transform(c, lambda x: x["e"])
    again = F.filter("es", lambda x: x["event_id"] % 10 == 0)
    side = lambda t, c, extra: F.struct(F.lit(t).cast("long").alias("teamId"), F.lit(f"Team {t}").alias("name"), F.col(c).alias("players"), *extra)
    body = F.struct(
        F.lit("2024-08-01").alias("startDate"), F.when(F.col("match_id") % 3 == 0, "6").otherwise("1").alias("statusCode"), F.lit("1 : 0").alias("score"), F.when(F.col("match_id") % 2 == 0, "1 : 0").otherwise(" ").alias("ftScore"),
        side(1, "h", [just(again).alias("incidentEvents")]).alias("home"), side(2, "a", []).alias("away"), just(F.col("es")).alias("events"),
    )
    return listed.join(sides, "match_id").select("match_id", F.to_json(body).alias("payload"))


def extract_embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads found again in pages that hold them."""
    page = F.concat(F.lit('<html><script>var a = "{"; require.data = '), F.col("payload"), F.lit("; f({});</script>"))
    pages = nes.extract_embedded_json(_payloads(spark, sf_dir).select("match_id", page.alias("html")), "require.data = ")
    return ing.parsed(pages).select("match_id", F.size("p.events").cast("long").alias("events"), F.size("p.home.players").cast("long").alias("home_players"))


def walk_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where event objects are in all payloads."""
    found = nes.walk_raw_events(_payloads(spark, sf_dir))
    place = F.regexp_replace("json_path", r"\[\d+\]", "[]")
    return found.groupBy("match_id", place.alias("place")).agg(F.count("*").alias("objects"), F.count_distinct("event_json").alias("different"))


def flatten_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches."""
    return ing.flatten_matches(_payloads(spark, sf_dir))


def completed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that are over."""
    return ing.completed_filter(ing.flatten_matches(_payloads(spark, sf_dir))).select("match_id", "status_code")


def explode_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams of all matches."""
    return ing.explode_teams(_payloads(spark, sf_dir))


def explode_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineups of all matches."""
    return rounded(ing.explode_players(_payloads(spark, sf_dir)))


def explode_events_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all matches, once each."""
    return ing.explode_events_dedup(_payloads(spark, sf_dir)).select("match_id", "event_key", F.col("source").cast("long").alias("source"))


def _unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ing.unpack_coded_fields(ing.explode_events_dedup(_payloads(spark, sf_dir)))


def unpack_coded_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpacked events."""
    return rounded(_unpacked(spark, sf_dir).drop("qualifiers"))


def qualifiers_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualifiers of all events."""
    rows = ing.qualifiers_to_map(_unpacked(spark, sf_dir))
    return rows.select("match_id", "event_id", F.array_join("qualifier_names", ",").alias("names"), F.col("qualifier_values")["Zonex"].alias("zone_value"))


def stable_event_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable ids of all events."""
    rows = ing.stable_event_uid(_unpacked(spark, sf_dir), ("match_id", "team_id", "event_id", "type_name"), ("event_id",))
    return rows.select("match_id", "event_id", "event_uid")


_WANTED = {
    "match": (("match_id", "game_id"), "long", None), "when": (("ts", "minute"), "long", 0), "kind": (("type_name",), "string", "none"),
    "code": (("outcome_name",), "int", -1), "absent": (("nothing",), "double", 1.5),
}


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in another schema."""
    return ing.conform_schema(projected(spark, sf_dir, "match_events"), _WANTED | {"event_id": (("event_id",), "long", None)})


def union_by_name_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as one table."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("int").alias("nation"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").cast("long").alias("nation"), F.col("s_acctbal").alias("balance"))
    return ing.union_by_name_relaxed([a, b])


def scan_history_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of each customer and priority."""
    return ing.scan_history_dedup(table(spark, sf_dir, "orders"), ("o_custkey", "o_orderpriority"), ("o_orderdate", "o_orderkey")).select("o_custkey", "o_orderpriority", "o_orderkey")


def extract_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all pages."""
    return ing.extract_page_links(table(spark, sf_dir, "pages"))


def normalize_season_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all orders' seasons, written in several ways."""
    y, k = F.year("o_orderdate"), F.col("o_orderkey") % 5
    label = F.when(k == 0, y.cast("string")).when(k == 1, F.concat_ws("/", y.cast("string"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))).when(k == 2, F.concat_ws("_", y.cast("string"), (y + 1).cast("string"))).when(k == 3, "x")
    return table(spark, sf_dir, "orders").select("o_orderkey", ing.normalize_season_label(label).alias("season"))


def resolve_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry keys of all customers' segments."""
    registry = table(spark, sf_dir, "customer").select("c_mktsegment").distinct().select(
        F.md5(F.col("c_mktsegment").cast("binary")).alias("registry_key"), F.array(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("-")), F.lit("other")).alias("aliases")
    )
    return ing.resolve_alias(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", registry.where("registry_key < 'c'"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("player_id"), F.trunc("o_orderdate", "year").alias("valuation_date"), F.when(k % 7 == 0, 0).otherwise(F.round("o_totalprice").cast("long")).alias("market_value"),
        F.when(k % 14 == 0, "-").otherwise("v").alias("display"), F.when(k % 11 == 0, " Retired").otherwise("club").alias("club_name"), F.when(k % 3 > 0, k % 13).alias("source_timestamp"), k.alias("list_index"),
    )


def clean_valuation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records of all orders."""
    return ing.clean_valuation_records(_records(spark, sf_dir), "1999-06-01").drop("display", "club_name", "source_timestamp")


def quality_issue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of all records."""
    roster = table(spark, sf_dir, "customer").where("c_custkey % 9 > 0").select(F.col("c_custkey").alias("player_id"))
    return ing.quality_issue_rows(roster, _records(spark, sf_dir).where("player_id % 4 > 0"))


def event_quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of all matches."""
    return ing.event_quality_checks(projected(spark, sf_dir, "match_events").withColumn("x", F.col("x") + 0.5))


def content_hash_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of files of pages, ten pages a file and ten files a group."""
    path = shared_path(spark, "page-files")
    pages = table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 100).alias("batch"), F.floor(F.col("page_id") / 10).alias("file"), "page_id", F.coalesce("html", F.lit("")).alias("value"))
    pages.repartition("batch", "file").sortWithinPartitions("batch", "file", "page_id").select("batch", "file", "value").write.partitionBy("batch", "file").text(path)
    return src.hash_files(spark, path, r"/file=(-?\d+)/", r"/batch=(-?\d+)/").withColumnRenamed("group", "batch")


QUERIES = (
    extract_embedded_json, walk_raw_events, flatten_matches, completed_filter, explode_teams, explode_players, explode_events_dedup, unpack_coded_fields, qualifiers_to_map, stable_event_uid, conform_schema,
    union_by_name_relaxed, scan_history_dedup, extract_page_links, normalize_season_label, resolve_alias, clean_valuation_records, quality_issue_rows,
    event_quality_checks, content_hash_files,
)

_M, _L = ctes("match_events"), ctes("player_matches")
_ID = "CASE WHEN event_id % 3 > 0 THEN event_id END"
_RECORDS = """records AS (SELECT o_custkey AS player_id, date_trunc('year', o_orderdate)::DATE AS valuation_date, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE round(o_totalprice)::BIGINT END AS market_value,
  o_orderkey % 14 = 0 AS hidden, o_orderkey % 11 = 0 AS retired, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 13 END AS ts, o_orderkey AS list_index FROM orders)"""

ORACLES = {
    "extract_embedded_json": f"""WITH {_L}, n AS (SELECT match_id, count(*) AS home_players FROM player_matches WHERE team_id = 1 GROUP BY match_id)
        SELECT e.match_id, count(*) AS events, any_value(n.home_players) AS home_players FROM match_events e JOIN n ON n.match_id = e.match_id GROUP BY e.match_id""",
    "walk_raw_events": f"""WITH {_M} SELECT match_id, '$.events[]' AS place, count(*) AS objects, count(*) AS different FROM match_events GROUP BY match_id
        UNION ALL SELECT match_id, '$.home.incidentEvents[]', count(*), count(*) FROM match_events WHERE event_id % 10 = 0 GROUP BY match_id""",
    "flatten_matches": f"WITH {_M} SELECT DISTINCT match_id, '2024-08-01' AS start_date, CASE WHEN match_id % 3 = 0 THEN '6' ELSE '1' END AS status_code, '1 : 0' AS score, CASE WHEN match_id % 2 = 0 THEN '1 : 0' ELSE ' ' END AS ft_score, 1::BIGINT AS home_team_id, 2::BIGINT AS away_team_id FROM match_events",
    "completed_filter": f"WITH {_M} SELECT DISTINCT match_id, CASE WHEN match_id % 3 = 0 THEN '6' ELSE '1' END AS status_code FROM match_events WHERE match_id % 3 = 0 OR match_id % 2 = 0",
    "explode_teams": f"WITH {_M} SELECT DISTINCT match_id, t.side, t.team_id, 'Team ' || t.team_id AS team_name FROM match_events, (VALUES ('home', 1::BIGINT), ('away', 2::BIGINT)) t(side, team_id)",
    "explode_players": rounded_sql(f"WITH {_L} SELECT match_id, team_id, player_id, 'P' || player_id AS player_name, position_code AS position, started = 1 AS started, minutes FROM player_matches", ["minutes"]),
    "explode_events_dedup": f"WITH {_M} SELECT match_id, CASE WHEN event_id % 3 > 0 THEN 'id:' || event_id ELSE 'event:' || event_id END AS event_key, 0::BIGINT AS source FROM match_events",
    "unpack_coded_fields": rounded_sql(f"""WITH {_M} SELECT match_id, {_ID} AS persistent_id, event_id, expanded_minute AS minute, event_second AS second, team_id, player_id, x, y, end_x, end_y, 0::BIGINT AS type_value,
        (outcome_name = 'Successful')::BIGINT AS outcome_value, period_value, type_name, outcome_name, 'Half' AS period_name, is_shot = 1 AS is_shot FROM match_events""", ["x", "y", "end_x", "end_y"]),
    "qualifiers_to_map": f"WITH {_M} SELECT match_id, event_id, pass_kind || ',Zonex' AS names, body_part AS zone_value FROM match_events",
    "stable_event_uid": f"""WITH {_M} SELECT match_id, event_id, CASE WHEN event_id % 3 > 0 THEN match_id || ':' || event_id ELSE 'fallback:' || md5(match_id || '|' || team_id || '|' || event_id || '|' || type_name || '|'
        || row_number() OVER (PARTITION BY match_id, event_id % 3 > 0 ORDER BY event_id)) END AS event_uid FROM match_events""",
    "conform_schema": f'WITH {_M} SELECT match_id AS match, 0::BIGINT AS "when", type_name AS kind, -1 AS code, 1.5::DOUBLE AS absent, event_id FROM match_events',
    "union_by_name_relaxed": "SELECT c_custkey AS key, c_mktsegment AS segment, c_nationkey::BIGINT AS nation, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_nationkey, s_acctbal FROM supplier",
    "scan_history_dedup": "SELECT o_custkey, o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "extract_page_links": r"""WITH l AS (SELECT page_id, regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*href="([^"]*)"', 1) AS hs FROM pages),
        u AS (SELECT page_id, unnest(hs) AS href, unnest(range(0, len(hs))) AS pos FROM l) SELECT page_id, href, min(pos) AS pos FROM u GROUP BY page_id, href""",
    "normalize_season_label": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1) END AS season FROM orders",
    "resolve_alias": "SELECT c_custkey, c_mktsegment, CASE WHEN md5(c_mktsegment) < 'c' THEN md5(c_mktsegment) END AS registry_key FROM customer",
    "clean_valuation_records": f"""WITH {_RECORDS} SELECT player_id, valuation_date, market_value, list_index, market_value > 0 AND NOT hidden AS is_value_valid, retired OR (hidden AND market_value = 0) AS is_terminal_record,
        valuation_date > DATE '1999-06-01' AS is_future_dated, market_value > 0 AND NOT hidden AND NOT (retired OR (hidden AND market_value = 0)) AND NOT valuation_date > DATE '1999-06-01' AS is_valid_for_model
        FROM records QUALIFY row_number() OVER (PARTITION BY player_id, valuation_date ORDER BY coalesce(ts, -1) DESC, list_index DESC) = 1""",
    "quality_issue_rows": f"""WITH {_RECORDS}, r AS (SELECT * FROM records WHERE player_id % 4 > 0), p AS (SELECT c_custkey AS player_id FROM customer WHERE c_custkey % 9 > 0)
        SELECT 'duplicate_record' AS issue_type, 'warning' AS severity, player_id, valuation_date::VARCHAR AS key FROM r GROUP BY player_id, valuation_date HAVING count(*) > 1
        UNION ALL SELECT 'missing_document', 'warning', player_id, NULL FROM p WHERE player_id NOT IN (SELECT player_id FROM r)
        UNION ALL SELECT DISTINCT 'not_in_roster', 'error', player_id, NULL FROM r WHERE player_id NOT IN (SELECT player_id FROM p)""",
    "event_quality_checks": f"""WITH {_M}, s AS (SELECT match_id, count(event_id) - count(DISTINCT event_id) AS d, count(*) FILTER (WHERE NOT x + 0.5 BETWEEN 0 AND 100 OR NOT y BETWEEN 0 AND 100) AS r,
        count(*) FILTER (WHERE type_name = 'Pass') AS p, count(*) FILTER (WHERE is_shot = 1) AS s, count(*) FILTER (WHERE event_id IS NULL) AS n FROM match_events GROUP BY match_id)
        SELECT match_id, 'unique_events' AS "check", 'error' AS severity, d AS n, d = 0 AS passed FROM s UNION ALL SELECT match_id, 'coordinate_range', 'error', r, r = 0 FROM s
        UNION ALL SELECT match_id, 'has_passes', 'error', p, p > 0 FROM s UNION ALL SELECT match_id, 'has_shots', 'warning', s, s > 0 FROM s UNION ALL SELECT match_id, 'id_coverage', 'info', n, n = 0 FROM s""",
    "content_hash_files": """SELECT batch::VARCHAR AS batch, sha256(string_agg(line, chr(10) ORDER BY line)) AS signature, count(*) AS files FROM (
        SELECT page_id // 100 AS batch, (page_id // 10) || ':' || sha256(string_agg(coalesce(html, '') || chr(10), '' ORDER BY page_id)) AS line FROM pages GROUP BY page_id // 100, page_id // 10) t GROUP BY batch""",
}
