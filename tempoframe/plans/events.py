"""Queries over event sequences, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.operators import sequences as seq
from tempoframe.plans.fixtures import ctes, projected


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(spark, sf_dir, "match_events")


def event_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock of every event."""
    raw = _events(spark, sf_dir).select("match_id", "event_id", "expanded_minute", F.col("event_second").alias("second"))
    return rounded(seq.event_clock(raw).select("match_id", "event_id", "event_time_seconds", "cumulative_mins"))


def infer_carries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All carries."""
    return rounded(seq.infer_carries(_events(spark, sf_dir)))


def opponent_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opponents by match and team."""
    return seq.opponent_map(_events(spark, sf_dir))


def defensive_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threat before and after every defensive action."""
    return rounded(seq.defensive_value(_events(spark, sf_dir), projected(spark, sf_dir, "value_grid")))


def action_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed passes and carries."""
    events = _events(spark, sf_dir)
    return rounded(seq.action_union(events, seq.infer_carries(events)))


def grid_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end zones of all events."""
    return seq.grid_zones(_events(spark, sf_dir)).select("match_id", "event_id", "start_zone", "end_zone")


def grid_value_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid value added by completed passes and carries."""
    events = _events(spark, sf_dir)
    actions = seq.action_union(events, seq.infer_carries(events))
    scored = seq.grid_value_added(actions, projected(spark, sf_dir, "value_grid"), "xt")
    return rounded(scored.select("action_type", "match_id", "event_id", "start_zone", "end_zone", *(f"xt_{x}" for x in ("start", "end", "added", "added_positive", "added_negative"))))


def left_join_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carries of each player of each match: the flagship query."""
    events = _events(spark, sf_dir)
    base = events.select("match_id", "player_id").dropna().distinct()
    carries = seq.infer_carries(events)
    sums = [F.count("*").alias("carries"), F.sum("carry_distance_m").alias("carry_metres"), F.sum("is_progressive_carry").alias("progressive_carries")]
    return rounded(seq.left_join_aggregates(base, [(carries, sums)]))


QUERIES = (event_clock, infer_carries, opponent_map, defensive_value, action_union, grid_zones, grid_value_added, left_join_aggregates)

CARRIES = """
flagged AS (
  SELECT *, type_name IN ('SubstitutionOff', 'SubstitutionOn', 'Card', 'FormationChange', 'Foul')
            OR (type_name = 'TakeOn' AND outcome_name IN ('Successful', 'Unsuccessful')) AS passed,
         type_name = 'Challenge' AND outcome_name = 'Unsuccessful' AS lost,
         row_number() OVER (PARTITION BY match_id, period_value ORDER BY event_time_seconds, event_id) AS rn FROM match_events),
ahead AS (
  SELECT *, first_value(CASE WHEN NOT passed AND NOT lost THEN rn END IGNORE NULLS) OVER w AS next_rn,
         first_value(CASE WHEN lost THEN rn END IGNORE NULLS) OVER (PARTITION BY match_id, period_value, team_id ORDER BY rn
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS own_rn,
         lead(event_time_seconds) OVER (PARTITION BY match_id, period_value ORDER BY rn) AS after_time,
         sum(CASE WHEN type_name = 'TakeOn' AND outcome_name = 'Successful' THEN 1 ELSE 0 END)
           OVER (PARTITION BY match_id, period_value ORDER BY rn) AS dribbles
  FROM flagged WINDOW w AS (PARTITION BY match_id, period_value ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
paired AS (
  SELECT p.match_id, p.event_id + 0.5::DOUBLE AS event_id, 'carry:' || p.event_id || ':' || n.event_id AS event_uid,
         p.event_id AS source_event_id, n.event_id AS target_event_id, p.period_value,
         (p.event_time_seconds + p.after_time) / 2.0::DOUBLE AS event_time_seconds, n.team_id, n.player_id,
         p.end_x AS x, p.end_y AS y, n.x AS end_x, n.y AS end_y, (n.event_time_seconds - p.event_time_seconds)::DOUBLE AS carry_duration_seconds,
         sqrt(pow((n.x - p.end_x) * 1.05, 2) + pow((n.y - p.end_y) * 0.68, 2)) AS carry_distance_m,
         sqrt(pow(n.x - p.end_x, 2) + pow(n.y - p.end_y, 2)) AS carry_distance_100, (n.dribbles - p.dribbles)::BIGINT AS take_ons,
         sqrt(pow(120 - p.end_x * 1.2, 2) + pow(40 - p.end_y * 0.8, 2)) - sqrt(pow(120 - n.x * 1.2, 2) + pow(40 - n.y * 0.8, 2)) AS nearer
  FROM ahead p JOIN ahead n ON n.match_id = p.match_id AND n.period_value = p.period_value AND n.rn = p.next_rn
  WHERE p.type_name IN ('Pass', 'TakeOn', 'BallRecovery', 'Interception', 'Tackle', 'KeeperPickup', 'KeeperSweeper', 'Clearance', 'BlockedPass')
    AND p.outcome_name = 'Successful' AND p.end_x IS NOT NULL AND p.end_y IS NOT NULL AND n.x IS NOT NULL AND n.y IS NOT NULL
    AND (p.own_rn IS NULL OR p.own_rn > p.next_rn) AND n.team_id = p.team_id
    AND n.type_name IN ('Pass', 'Shot', 'SavedShot', 'MissedShots', 'Goal', 'TakeOn', 'BallTouch', 'Dispossessed')),
carries AS (
  SELECT * EXCLUDE (nearer),
         CASE WHEN (x * 1.2 < 60 AND end_x * 1.2 < 60 AND nearer >= 32.8) OR (x * 1.2 < 60 AND end_x * 1.2 >= 60 AND nearer >= 16.4)
                OR (x * 1.2 >= 60 AND end_x * 1.2 >= 60 AND nearer >= 10.94) THEN 1 ELSE 0 END::BIGINT AS is_progressive_carry,
         CASE WHEN x < 66.7 AND end_x >= 66.7 THEN 1 ELSE 0 END::BIGINT AS is_final_third_carry,
         CASE WHEN NOT (x >= 85 AND y BETWEEN 22.5 AND 77.5) AND end_x >= 85 AND end_y BETWEEN 22.5 AND 77.5 THEN 1 ELSE 0 END::BIGINT AS is_carry_into_box
  FROM paired WHERE carry_duration_seconds BETWEEN 1 AND 10 AND carry_distance_m BETWEEN 5 AND 60)"""

ACTIONS = """
actions AS (
  SELECT 'pass' AS action_type, match_id, team_id, player_id, period_value, event_time_seconds::DOUBLE AS event_time_seconds, event_id::DOUBLE AS event_id,
         x, y, end_x, end_y FROM match_events
  WHERE type_name = 'Pass' AND outcome_name = 'Successful' AND x IS NOT NULL AND y IS NOT NULL AND end_x IS NOT NULL AND end_y IS NOT NULL
  UNION ALL
  SELECT 'carry', match_id, team_id, player_id, period_value, event_time_seconds, event_id, x, y, end_x, end_y FROM carries)"""


def zone_sql(x: str, y: str) -> str:
    """Cell of the 12 by 8 grid."""
    return f"(floor(least(greatest({x}, 0), 99.999) / 100 * 12) + 12 * floor(least(greatest({y}, 0), 99.999) / 100 * 8))::BIGINT"


VALUED = f"""
valued AS (
  SELECT a.*, coalesce(s.grid_value, 0) AS xt_start, coalesce(e.grid_value, 0) AS xt_end,
         {zone_sql("x", "y")} AS start_zone, {zone_sql("end_x", "end_y")} AS end_zone
  FROM actions a LEFT JOIN value_grid s ON s.zone = {zone_sql("a.x", "a.y")} LEFT JOIN value_grid e ON e.zone = {zone_sql("a.end_x", "a.end_y")})"""

DEFENCE = f"""
opponents AS (
  SELECT DISTINCT m.match_id, m.team_id, CASE WHEN m.team_id = t.a THEN t.b ELSE t.a END AS opponent_team_id
  FROM match_events m JOIN (SELECT match_id, min(team_id) AS a, max(team_id) AS b FROM match_events GROUP BY match_id
                            HAVING count(DISTINCT team_id) = 2) t ON t.match_id = m.match_id),
ordered AS (
  SELECT m.*, o.opponent_team_id, type_name NOT IN ('SubstitutionOff', 'SubstitutionOn', 'Card', 'FormationChange') AS seen,
         row_number() OVER (PARTITION BY m.match_id, period_value ORDER BY event_time_seconds, event_id) AS rn
  FROM match_events m JOIN opponents o ON o.match_id = m.match_id AND o.team_id = m.team_id),
acts AS (
  SELECT a.*, (SELECT max(b.rn) FROM ordered b WHERE b.match_id = a.match_id AND b.period_value = a.period_value AND b.rn < a.rn
               AND b.seen AND b.team_id = a.opponent_team_id) AS prev_rn,
         (SELECT min(b.rn) FROM ordered b WHERE b.match_id = a.match_id AND b.period_value = a.period_value AND b.rn > a.rn AND b.seen) AS next_rn
  FROM ordered a WHERE type_name IN ('Tackle', 'Interception', 'BallRecovery', 'Clearance', 'BlockedPass', 'Challenge', 'Save', 'KeeperPickup', 'KeeperSweeper', 'Aerial')),
states AS (
  SELECT a.*, coalesce(a.event_time_seconds - p.event_time_seconds <= 15, FALSE) AS known, coalesce(n.event_time_seconds - a.event_time_seconds <= 12, FALSE) AS follows,
         n.team_id AS next_team, coalesce(p.end_x, p.x) AS px, coalesce(p.end_y, p.y) AS py, coalesce(n.end_x, n.x) AS qx, coalesce(n.end_y, n.y) AS qy
  FROM acts a LEFT JOIN ordered p ON p.match_id = a.match_id AND p.period_value = a.period_value AND p.rn = a.prev_rn
  LEFT JOIN ordered n ON n.match_id = a.match_id AND n.period_value = a.period_value AND n.rn = a.next_rn),
sourced AS (
  SELECT *, CASE WHEN known THEN 'previous_opponent_event' ELSE 'mirrored_defensive_location' END AS before_source,
         CASE WHEN follows AND next_team = team_id THEN 'defending_team_next_event' WHEN follows THEN 'opponent_next_event'
              WHEN outcome_name = 'Successful' OR type_name IN ('Clearance', 'Save', 'KeeperPickup', 'KeeperSweeper') THEN 'no_next_event_successful_stop'
              ELSE 'no_next_event_no_credit' END AS after_source,
         CASE WHEN known THEN {zone_sql("px", "py")} ELSE {zone_sql("(100 - x)", "(100 - y)")} END AS bz, {zone_sql("qx", "qy")} AS az FROM states),
threats AS (
  SELECT s.*, coalesce(b.grid_value, 0) AS opponent_xpv_before,
         CASE after_source WHEN 'opponent_next_event' THEN coalesce(g.grid_value, 0) WHEN 'no_next_event_no_credit' THEN coalesce(b.grid_value, 0) ELSE 0 END AS opponent_xpv_after
  FROM sourced s LEFT JOIN value_grid b ON b.zone = bz LEFT JOIN value_grid g ON g.zone = az),
defence AS (
  SELECT match_id, event_id, team_id, opponent_team_id, player_id, period_value, type_name, before_source, after_source,
         opponent_xpv_before::DOUBLE AS opponent_xpv_before, opponent_xpv_after::DOUBLE AS opponent_xpv_after,
         (opponent_xpv_before - opponent_xpv_after)::DOUBLE AS net_threat_reduction,
         greatest(opponent_xpv_before - opponent_xpv_after, 0)::DOUBLE AS opponent_threat_prevented,
         greatest(opponent_xpv_after - opponent_xpv_before, 0)::DOUBLE AS opponent_threat_increased FROM threats)"""

_M, _G = ctes("match_events"), ctes("match_events", "value_grid")
_CARRY_DOUBLES = ["event_id", "event_time_seconds", "x", "y", "end_x", "end_y", "carry_duration_seconds", "carry_distance_m", "carry_distance_100"]

ORACLES = {
    "event_clock": rounded_sql(f"""WITH {_M} SELECT match_id, event_id, (expanded_minute * 60 + event_second)::DOUBLE AS event_time_seconds,
        (expanded_minute * 60 + event_second)::DOUBLE / 60 AS cumulative_mins FROM match_events""", ["event_time_seconds", "cumulative_mins"]),
    "infer_carries": rounded_sql(f"WITH {_M}, {CARRIES} SELECT * FROM carries", _CARRY_DOUBLES),
    "opponent_map": f"""WITH {_M}, t AS (SELECT DISTINCT match_id, team_id FROM match_events WHERE team_id IS NOT NULL)
        SELECT a.match_id, a.team_id, b.team_id AS opponent_team_id FROM t a JOIN t b ON a.match_id = b.match_id AND a.team_id <> b.team_id
        WHERE a.match_id IN (SELECT match_id FROM t GROUP BY match_id HAVING count(*) = 2)""",
    "defensive_value": rounded_sql(f"WITH {_G}, {DEFENCE} SELECT * FROM defence", ["opponent_xpv_before", "opponent_xpv_after", "net_threat_reduction", "opponent_threat_prevented", "opponent_threat_increased"]),
    "action_union": rounded_sql(f"WITH {_M}, {CARRIES}, {ACTIONS} SELECT * FROM actions", ["event_time_seconds", "event_id", "x", "y", "end_x", "end_y"]),
    "grid_zones": f"WITH {_M} SELECT match_id, event_id, {zone_sql('x', 'y')} AS start_zone, {zone_sql('end_x', 'end_y')} AS end_zone FROM match_events",
    "grid_value_added": rounded_sql(f"""WITH {_G}, {CARRIES}, {ACTIONS}, {VALUED}
        SELECT action_type, match_id, event_id, start_zone, end_zone, xt_start, xt_end, xt_end - xt_start AS xt_added,
               greatest(xt_end - xt_start, 0) AS xt_added_positive, least(xt_end - xt_start, 0) AS xt_added_negative FROM valued""",
        ["event_id", "xt_start", "xt_end", "xt_added", "xt_added_positive", "xt_added_negative"]),
    "left_join_aggregates": rounded_sql(f"""WITH {_M}, {CARRIES}
        SELECT b.match_id, b.player_id, count(c.event_id) AS carries, coalesce(sum(c.carry_distance_m), 0) AS carry_metres,
               coalesce(sum(c.is_progressive_carry), 0)::BIGINT AS progressive_carries
        FROM (SELECT DISTINCT match_id, player_id FROM match_events) b LEFT JOIN carries c ON c.match_id = b.match_id AND c.player_id = b.player_id
        GROUP BY b.match_id, b.player_id""", ["carry_metres"]),
}
