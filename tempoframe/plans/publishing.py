"""Queries over entities and serving tables, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.functions.state import shared_path, written
from tempoframe.functions.text import normalize_name as _normalize
from tempoframe.operators import entities as ent
from tempoframe.operators import serving as ser
from tempoframe.plans.fixtures import ctes, on_tables, projected, table
from tempoframe.sources import files as src

ENTITIES = """
named AS (SELECT c_custkey AS player_id, 'Name-' || CAST(c_custkey % 1200 AS VARCHAR(20)) || ' X' AS player_name, c_nationkey AS team_id, c_mktsegment AS position, c_acctbal FROM customer),
candidates AS (SELECT c_custkey + 1000000 AS candidate_id, 'name ' || CAST(c_custkey * 7 % 1300 AS VARCHAR(20)) || ' x' AS name_key FROM customer)"""


def _sql(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    return on_tables(spark, sf_dir, f"WITH {ENTITIES} {select}")


def _left(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "SELECT * FROM named").withColumns({"match_date": F.lit("2024-01-01").cast("date"), "match_id": F.col("player_id")})
    return ent.collect_entities(rows)


def _right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT * FROM candidates")


def _overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "SELECT player_id, player_id + 1000000 AS candidate_id FROM named WHERE player_id % 50 = 0")


def collect_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players of the order fixture with their modal position group."""
    rows = projected(spark, sf_dir, "player_ratings").withColumns({"player_name": F.concat(F.lit("N-"), F.col("position_group")), "team_id": F.col("match_id") % 9, "position": F.col("position_group")})
    return ent.collect_entities(rows)


def exact_unique_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches of all names."""
    return ent.exact_unique_match(_left(spark, sf_dir), _right(spark, sf_dir))


def override_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of all names after overrides."""
    return ent.match_entities(_left(spark, sf_dir), _right(spark, sf_dir), _overrides(spark, sf_dir))


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are left for review."""
    left, right = _left(spark, sf_dir), _right(spark, sf_dir)
    return ent.review_queue(left, right, ent.exact_unique_match(left, right)).drop("candidate_ids")


def assert_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched pairs, checked."""
    return ent.assert_one_to_one(override_match(spark, sf_dir), "player_id", "candidate_id")


def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised keys of all documents' texts, as digests."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.md5(_normalize("text").cast("binary")).alias("key_md5"))


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rating of every player."""
    return rounded(ser.latest_per_key(projected(spark, sf_dir, "player_ratings"), ["player_id"], ["match_date", "match_id"]))


_LABELS = {"minutes": "Minutes", "rating": "Rating", "low": "Low rating"}


def top_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest components of all ratings."""
    rows = projected(spark, sf_dir, "player_ratings").withColumn("low", F.when(F.col("rating") < 4, -F.col("rating") * 10))
    return ser.top_components(rows, _LABELS).select("player_id", "match_id", "explanation")


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = table(spark, sf_dir, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("player_id"))
    odds = table(spark, sf_dir, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("player_id"), ((F.col("c_custkey") % 101).cast("double") / 100).alias("p_increase"))
    return ser.player_snapshot(projected(spark, sf_dir, "player_ratings"), mapped, projected(spark, sf_dir, "player_valuations"), odds)


def player_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of all mapped players."""
    return rounded(_snapshot(spark, sf_dir).select("player_id", "match_id", "rating", "market_value", "valuation_date", "p_increase", "direction", "confidence"))


def valuation_history_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valuations of the players in the snapshot."""
    return ser.valuation_history_semi(projected(spark, sf_dir, "player_valuations"), _snapshot(spark, sf_dir))


def match_impacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impacts of all ratings."""
    return rounded(ser.match_impacts(projected(spark, sf_dir, "player_ratings")).select("player_id", "match_id", "impact", "impact_label"))


def publish_update_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with those of every fifth match overwritten."""
    rows = projected(spark, sf_dir, "player_ratings").select("player_id", "match_id", "rating", "minutes")
    new = rows.where("match_id % 5 = 0").withColumns({"rating": F.col("rating") + 1, "minutes": F.lit(None).cast("double")})
    return rounded(ser.publish_update_join(rows, new, ["player_id", "match_id"], ["rating", "minutes"]))


def lateral_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with newest rating and value."""
    players = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"))
    return rounded(ser.lateral_top1(players, projected(spark, sf_dir, "player_ratings"), projected(spark, sf_dir, "player_valuations")))


def player_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last twenty matches of player 7."""
    rows = projected(spark, sf_dir, "player_ratings").withColumn("rating_version", F.when(F.col("match_id") % 3 == 0, "v1").otherwise("v2"))
    return rounded(ser.player_detail(rows, 7).select("player_id", "match_id", "rating", "impact", "impact_label", "sequence"))


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 25 orders as runs."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), F.col("o_orderstatus").alias("status"))
    return ser.recent_runs(runs, 25).select("run_id", "status")


def name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose name contains 0001."""
    return ser.name_search(table(spark, sf_dir, "customer"), " R#00000001", "c_name").select("c_custkey", "c_name")


def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of orders by priority and customer."""
    status = F.when(F.col("o_orderkey") % 5 == 0, "failed_validation").when(F.col("o_orderkey") % 3 == 0, "skipped_completed").otherwise("processed")
    return ser.run_rollup(table(spark, sf_dir, "orders").withColumn("status", status), ["o_custkey"])


def sink_keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings, written as a keyed table, after an upsert of newer and changed rows, applied twice and read back."""
    digest = F.md5(F.col("rating").cast("decimal(10,2)").cast("string").cast("binary"))
    rows = written(projected(spark, sf_dir, "player_ratings").select("player_id", "match_id", "rating").withColumn("h", digest), "upsert-rows")
    source = rows.where("match_id % 3 = 0").withColumn("rating", F.col("rating") + 1).withColumn("h", digest)
    path = shared_path(spark, "keyed")
    for part in (rows.where("match_id % 4 > 0"), source, source):
        src.sink_keyed_upsert(part, path, ["player_id", "match_id"], "h")
    return rounded(src.keyed_table(spark, path).drop("h"))


QUERIES = (
    collect_entities, exact_unique_match, override_match, review_queue, assert_one_to_one, normalize_name, latest_per_key, top_components, player_snapshot,
    valuation_history_semi, match_impacts, publish_update_join, lateral_top1, player_detail, recent_runs, name_search, run_rollup, sink_keyed_upsert,
)

_R, _V = ctes("player_ratings"), ctes("player_ratings", "player_valuations")
_E = f"""WITH {ENTITIES}, lefts AS (SELECT player_id, trim(regexp_replace(lower(player_name), '[^a-z0-9]+', ' ', 'g')) AS name_key FROM named)"""


def _unique(left: str, right: str) -> str:
    return f"""SELECT l.player_id, r.candidate_id, 'exact_name' AS method, 0.95::DOUBLE AS confidence
  FROM (SELECT *, count(*) OVER (PARTITION BY name_key) AS n FROM {left}) l JOIN (SELECT *, count(*) OVER (PARTITION BY name_key) AS n FROM {right}) r
  ON l.name_key = r.name_key AND l.n = 1 AND r.n = 1"""


_MATCHED = f"""fixed AS (SELECT player_id, player_id + 1000000 AS candidate_id, 'override' AS method, 1.0::DOUBLE AS confidence FROM named WHERE player_id % 50 = 0),
matched AS (SELECT * FROM fixed UNION ALL {_unique("(SELECT * FROM lefts WHERE player_id NOT IN (SELECT player_id FROM fixed)) a", "(SELECT * FROM candidates WHERE candidate_id NOT IN (SELECT candidate_id FROM fixed)) b")})"""
_SNAP = """latest AS (SELECT * FROM player_ratings QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY match_date DESC, match_id DESC) = 1),
snap AS (
  SELECT l.player_id, l.match_id, l.rating, v.market_value, v.valuation_date, CASE WHEN l.player_id % 4 > 0 THEN (l.player_id % 101)::DOUBLE / 100 END AS p_increase
  FROM latest l LEFT JOIN (SELECT * FROM player_valuations QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY valuation_date DESC) = 1) v ON v.player_id = l.player_id
  WHERE l.player_id % 3 > 0 AND l.player_id IN (SELECT c_custkey FROM customer))"""
_IMPACT = "rating - 6 AS impact, CASE WHEN rating > 6.25 THEN 'positive' WHEN rating < 5.75 THEN 'negative' ELSE 'neutral' END AS impact_label"

ORACLES = {
    "collect_entities": f"""WITH {_R}, n AS (SELECT player_id, 'N-' || position_group AS player_name, count(*) AS k FROM player_ratings GROUP BY ALL),
        best AS (SELECT player_id, player_name FROM n QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY k DESC, player_name) = 1)
        SELECT r.player_id, b.player_name, arg_max(match_id % 9, (match_date, match_id)) AS team_id, arg_max(position_group, (match_date, match_id)) AS position,
               count(*) AS appearances, trim(regexp_replace(lower(b.player_name), '[^a-z0-9]+', ' ', 'g')) AS name_key
        FROM player_ratings r JOIN best b ON b.player_id = r.player_id GROUP BY r.player_id, b.player_name""",
    "exact_unique_match": f"{_E} {_unique('lefts', 'candidates')}",
    "override_match": f"{_E}, {_MATCHED} SELECT * FROM matched",
    "review_queue": f"""{_E}, m AS ({_unique('lefts', 'candidates')}), f AS (SELECT name_key, count(*) AS n FROM candidates WHERE candidate_id NOT IN (SELECT candidate_id FROM m) GROUP BY name_key)
        SELECT l.player_id, l.name_key, coalesce(f.n, 0) AS candidates, CASE WHEN f.n > 0 THEN 'ambiguous' ELSE 'none' END AS reason
        FROM lefts l LEFT JOIN f ON f.name_key = l.name_key WHERE l.player_id NOT IN (SELECT player_id FROM m)""",
    "assert_one_to_one": f"{_E}, {_MATCHED} SELECT player_id, candidate_id FROM matched",
    "normalize_name": "SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(replace(text, 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g'))) AS key_md5 FROM documents WHERE text IS NOT NULL",
    "latest_per_key": rounded_sql(f"WITH {_R}, {_SNAP.split('snap AS')[0].rstrip().rstrip(',')} SELECT * FROM latest", ["minutes", "rating"]),
    "top_components": f"""WITH {_R}, parts AS (
          SELECT player_id, match_id, abs(minutes) AS size, 0 AS k, 'Minutes' AS label FROM player_ratings UNION ALL SELECT player_id, match_id, abs(rating), 1, 'Rating' FROM player_ratings
          UNION ALL SELECT player_id, match_id, rating * 10, 2, 'Low rating' FROM player_ratings WHERE rating < 4)
        SELECT player_id, match_id, string_agg(label, ' · ' ORDER BY size DESC, k) AS explanation
        FROM (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY player_id, match_id ORDER BY size DESC, k) <= 2) t GROUP BY player_id, match_id""",
    "player_snapshot": rounded_sql(f"""WITH {_V}, {_SNAP} SELECT *, CASE WHEN p_increase >= 0.6 THEN 'rising' WHEN p_increase <= 0.4 THEN 'falling' WHEN p_increase IS NOT NULL THEN 'stable' END AS direction,
        CASE WHEN p_increase IS NOT NULL THEN greatest(p_increase, 1 - p_increase) END AS confidence FROM snap""", ["rating", "p_increase", "confidence"]),
    "valuation_history_semi": f"WITH {_V}, {_SNAP} SELECT * FROM player_valuations WHERE player_id IN (SELECT player_id FROM snap)",
    "match_impacts": rounded_sql(f"WITH {_R} SELECT player_id, match_id, {_IMPACT} FROM player_ratings", ["impact"]),
    "publish_update_join": rounded_sql(f"WITH {_R} SELECT player_id, match_id, CASE WHEN match_id % 5 = 0 THEN rating + 1 ELSE rating END AS rating, CASE WHEN match_id % 5 > 0 THEN minutes END AS minutes FROM player_ratings", ["rating", "minutes"]),
    "lateral_top1": rounded_sql(f"""WITH {_V} SELECT c_custkey AS player_id, f.rating AS newest_rating, f.match_id AS newest_match, v.market_value AS newest_value FROM customer
        LEFT JOIN (SELECT * FROM player_ratings QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY match_date DESC, match_id DESC) = 1) f ON f.player_id = c_custkey
        LEFT JOIN (SELECT * FROM player_valuations QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY valuation_date DESC) = 1) v ON v.player_id = c_custkey""", ["newest_rating"]),
    "player_detail": rounded_sql(f"""WITH {_R}, t AS (SELECT *, CASE WHEN match_id % 3 = 0 THEN 'v1' ELSE 'v2' END AS version FROM player_ratings WHERE player_id = 7),
        u AS (SELECT * FROM t WHERE version = (SELECT max(version) FROM t) ORDER BY match_date DESC, match_id DESC LIMIT 20)
        SELECT player_id, match_id, rating, {_IMPACT}, row_number() OVER (ORDER BY match_date, match_id) AS sequence FROM u""", ["rating", "impact"]),
    "recent_runs": "SELECT o_orderkey AS run_id, o_orderstatus AS status FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25",
    "name_search": "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%r#00000001%'",
    "run_rollup": """SELECT *, CASE WHEN failed = 0 THEN 'succeeded' WHEN processed + skipped > 0 THEN 'partial' ELSE 'failed' END AS run_status FROM (
        SELECT o_custkey, count(*) AS items, count(*) FILTER (WHERE o_orderkey % 5 > 0 AND o_orderkey % 3 > 0) AS processed,
               count(*) FILTER (WHERE o_orderkey % 5 > 0 AND o_orderkey % 3 = 0) AS skipped, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS failed FROM orders GROUP BY o_custkey) t""",
    "sink_keyed_upsert": rounded_sql(f"WITH {_R} SELECT player_id, match_id, CASE WHEN match_id % 3 = 0 THEN rating + 1 ELSE rating END AS rating FROM player_ratings WHERE match_id % 4 > 0 OR match_id % 3 = 0", ["rating"]),
}
