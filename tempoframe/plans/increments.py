"""Queries over increments and records, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.functions.state import written
from tempoframe.operators import incremental as inc
from tempoframe.operators.valuation import ratings_prepare, valuation_clean
from tempoframe.plans import forms
from tempoframe.plans.fixtures import ctes, dealt, parts, projected, table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id"), F.to_date("o_orderdate").alias("item_date"), F.col("o_orderstatus").alias("kind"))


def select_new_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of all orders as work items."""
    rows = _orders(spark, sf_dir)
    return inc.select_new_work(rows, rows.where("item_id % 3 = 0"), "2000-06-30", 100)


def input_signature_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions for all matches, of which every third is recorded and every sixth has changed."""
    rows = projected(spark, sf_dir, "player_ratings").groupBy("match_id").agg(F.count("*").alias("n"))
    rows = dealt(written(rows, "counts"), parts(spark, sf_dir), "match_id").select("match_id", F.md5(F.col("n").cast("string").cast("binary")).alias("input_hash"))
    was = inc.input_signature_skip(rows.where("match_id % 3 = 0"), rows.limit(0).select("match_id", F.lit("").alias("signature")), "{}", "v1")
    changed = rows.withColumn("input_hash", F.when(F.col("match_id") % 6 == 0, "new").otherwise(F.col("input_hash")))
    return inc.input_signature_skip(changed, was, "{}", "v1").select("match_id", "action")


def select_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last eight matches of all."""
    return inc.select_last_n(projected(spark, sf_dir, "player_ratings"), 8)


# A given frozen model: log change of value by form, trend and age, and half the width of its 90 % interval.
_LOG_CHANGE = "0.03 * (asof_form - 5.5) + 0.01 * coalesce(rating_trend, 0) - 0.004 * (age_at_valuation - 27)"
_HALF_WIDTH = 0.35


def _frozen(features: DataFrame) -> DataFrame:
    made = features.withColumn("log_change", F.expr(_LOG_CHANGE))
    return made.withColumns({"log_lower": F.col("log_change") - _HALF_WIDTH, "log_upper": F.col("log_change") + _HALF_WIDTH})


def replay_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replays of every player's last five matches."""
    values = valuation_clean(projected(spark, sf_dir, "player_valuations"))
    return rounded(inc.replay_sequence(values, ratings_prepare(projected(spark, sf_dir, "rated_matches")), 5, _frozen), 4)


def stamp_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped ratings."""
    rows = projected(spark, sf_dir, "player_ratings").select("player_id", "match_id")
    return inc.stamp_provenance(rows, "given", "2024-2025", "v1", "2024-01-02 03:04:05").withColumn("scored_at", F.col("scored_at").cast("string"))


def roster_priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of three overlapping lists."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"), F.col("c_nationkey").alias("club_id"))
    return inc.roster_priority_merge([c.where("player_id % 3 = 0"), c.where("player_id % 2 = 0"), c.where("player_id % 5 > 0")])


def clean_player_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records of all customers, some of them damaged."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.when(k % 11 == 0, "x").when(k % 7 == 0, (k - 1).cast("string")).otherwise(F.concat(F.lit(" "), k.cast("string"))).alias("id_text"),
        F.when(k % 13 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("c_name"))).alias("name_text"), F.when(k % 4 > 0, F.concat(F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("/02/2001"))).otherwise("soon").alias("birth_text"), k.alias("list_index"),
    )
    return inc.clean_player_records(rows)


def validate_match_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of all matches, of which every fourth lacks a lineup."""
    events = projected(spark, sf_dir, "match_events")
    return inc.validate_match_bundle(events.select("match_id").distinct(), events, projected(spark, sf_dir, "player_matches").where("match_id % 4 > 0"))


QUERIES = (select_new_work, input_signature_skip, select_last_n, replay_sequence, stamp_provenance, roster_priority_merge, clean_player_records, validate_match_bundle)

_R, _L = ctes("player_ratings"), ctes("player_matches")
ORACLES = {
    "select_new_work": """WITH s AS (SELECT o_orderkey AS item_id, o_orderdate::DATE AS item_date, o_orderstatus AS kind, CASE WHEN o_orderkey % 3 = 0 THEN 'completed' WHEN o_orderdate::DATE > DATE '2000-06-30' THEN 'deferred' ELSE 'open' END AS st FROM orders)
        SELECT item_id, item_date, kind, CASE WHEN st <> 'open' THEN st WHEN row_number() OVER (PARTITION BY st ORDER BY item_date DESC, item_id DESC) <= 100 THEN 'selected' ELSE 'waiting' END AS status FROM s""",
    "input_signature_skip": f"WITH {_R} SELECT DISTINCT match_id, CASE WHEN match_id % 3 = 0 AND match_id % 6 > 0 THEN 'skip' ELSE 'process' END AS action FROM player_ratings",
    "select_last_n": f"WITH {_R}, l AS (SELECT DISTINCT match_id, match_date FROM player_ratings ORDER BY match_date DESC, match_id DESC LIMIT 8) SELECT *, row_number() OVER (ORDER BY match_date, match_id) AS sequence FROM l",
    "replay_sequence": rounded_sql(f"""WITH {forms.VALUES}, steps AS (
          SELECT player_id, match_id, match_date, match_date + 1 AS valuation_date FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY match_date DESC, match_id DESC) AS k FROM prepared) t WHERE k <= 5),
        placed AS (
          SELECT s.player_id, s.match_id, s.match_date, s.valuation_date, max(c.valuation_date) AS previous_valuation_date, arg_max(c.market_value, c.valuation_date)::DOUBLE AS previous_value,
                 arg_max(c.age_at_valuation, c.valuation_date) + date_diff('day', max(c.valuation_date), s.valuation_date) / 365.25::DOUBLE AS age_at_valuation
          FROM steps s LEFT JOIN clean c ON c.player_id = s.player_id AND c.valuation_date < s.valuation_date
          GROUP BY s.player_id, s.match_id, s.match_date, s.valuation_date),
        intervals AS (SELECT DISTINCT player_id, valuation_date, previous_valuation_date, previous_value, age_at_valuation FROM placed), {forms.AS_OF_SQL},
        scored AS (SELECT player_id, valuation_date, {_LOG_CHANGE} AS c FROM feature_rows WHERE minutes >= 1),
        told AS (
          SELECT p.player_id, p.match_id, row_number() OVER (PARTITION BY p.player_id ORDER BY match_date, match_id) AS sequence,
                 CASE WHEN c IS NOT NULL THEN 'succeeded' WHEN previous_value IS NULL THEN 'skipped_missing_value' ELSE 'skipped_no_minutes' END AS status, asof_form, matches_last_20,
                 previous_value * exp(c) AS estimate, previous_value * exp(c - {_HALF_WIDTH}) AS estimate_lower, previous_value * exp(c + {_HALF_WIDTH}) AS estimate_upper
          FROM placed p LEFT JOIN rolling r ON r.player_id = p.player_id AND r.valuation_date = p.valuation_date LEFT JOIN scored s ON s.player_id = p.player_id AND s.valuation_date = p.valuation_date)
        SELECT *, estimate - last_value(estimate IGNORE NULLS) OVER (PARTITION BY player_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS estimate_change FROM told""",
        ["asof_form", "estimate", "estimate_lower", "estimate_upper", "estimate_change"], 4),
    "stamp_provenance": f"WITH {_R} SELECT player_id, match_id, 'given' AS provider, '2024-2025' AS season, 'v1' AS model_version, '2024-01-02 03:04:05' AS scored_at FROM player_ratings",
    "roster_priority_merge": "SELECT c_custkey AS player_id, c_nationkey AS club_id, CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS priority FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0 OR c_custkey % 5 > 0",
    "clean_player_records": """WITH s AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_custkey - 1 ELSE c_custkey END AS player_id, CASE WHEN c_custkey % 13 > 0 THEN c_name END AS player_name,
          CASE WHEN c_custkey % 4 > 0 THEN make_date(2001, 2, c_custkey % 28 + 1) END AS date_of_birth, c_custkey AS list_index FROM customer)
        SELECT *, CASE WHEN player_id IS NULL THEN 'missing_id' WHEN player_name IS NULL THEN 'missing_name' WHEN row_number() OVER (PARTITION BY player_id ORDER BY list_index) > 1 THEN 'duplicate' END AS issue FROM s""",
    "validate_match_bundle": f"""WITH {_L}, m AS (SELECT match_id, count(DISTINCT team_id) AS t, count(event_id) - count(DISTINCT event_id) AS r, count(*) FILTER (WHERE NOT x BETWEEN 0 AND 100 OR NOT y BETWEEN 0 AND 100) AS o FROM match_events GROUP BY match_id)
        SELECT match_id, c.k AS "check", c.s AS severity, c.p AS passed FROM (SELECT match_id, unnest([{{'k': 'one_match_row', 's': 'error', 'p': true}}, {{'k': 'events_present', 's': 'error', 'p': true}}, {{'k': 'two_teams', 's': 'error', 'p': t = 2}},
          {{'k': 'unique_events', 's': 'error', 'p': r = 0}}, {{'k': 'coordinates', 's': 'error', 'p': o = 0}}, {{'k': 'unique_players', 's': 'error', 'p': true}}, {{'k': 'lineup_present', 's': 'warning', 'p': match_id % 4 > 0}}]) AS c FROM m) u""",
}
