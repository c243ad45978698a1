"""Queries over passes and shots, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import layered_sql, rounded, rounded_sql
from tempoframe.operators import passes as pas
from tempoframe.operators import shots as sho
from tempoframe.plans.fixtures import ctes, projected

_KEYS = ("match_id", "event_id")
_KIND = {"corner": "CornerTaken", "free_kick": "FreekickTaken", "throw_in": "ThrowIn", "goal_kick": "GoalKick", "cross": "Cross", "through_ball": "Throughball", "long_ball": "Longball"}


def _with_qualifiers(events: DataFrame) -> DataFrame:
    """Events with the qualifier names that the fixture's columns stand for."""
    kind = F.create_map(*(F.lit(x) for p in _KIND.items() for x in p))[F.col("pass_kind")]
    names = F.array(
        kind, F.when(F.col("is_key_pass") == 1, "KeyPass"), F.when(F.col("is_assist") == 1, "Assist"),
        F.col("body_part"), F.col("situation"), F.when(F.col("is_own_goal") == 1, "OwnGoal"), F.when(F.col("related_event_id").isNotNull(), "Assisted"),
    )
    return events.withColumn("qualifier_names", F.array_compact(names)).drop("is_key_pass", "is_assist", "is_own_goal", "body_part", "situation")


def _passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pas.derive_passes(_with_qualifiers(projected(spark, sf_dir, "match_events")))


def _shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    shots = sho.derive_shots(_with_qualifiers(projected(spark, sf_dir, "match_events")))
    return shots.withColumns({"xg": F.col("xg_given"), "xgot": F.when(F.col("goal_mouth_y").isNotNull(), F.col("xg_given") / 2)})


_FLAGS = tuple(pas.PASS_FLAGS)


def qualifier_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass flags of all events."""
    events = _with_qualifiers(projected(spark, sf_dir, "match_events"))
    return pas.qualifier_flags(events, pas.PASS_FLAGS).select(*_KEYS, *_FLAGS)


def derive_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes with flags, length and angle."""
    return rounded(_passes(spark, sf_dir).select(*_KEYS, "success", *_FLAGS, "pass_length", "pass_angle"))


def pass_geometry_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometry of all passes."""
    return rounded(pas.pass_geometry_features(_passes(spark, sf_dir)).select(*_KEYS, *pas.NUMERIC, *pas.CATEGORIES))


def pass_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass totals by match and player."""
    return pas.pass_totals(_passes(spark, sf_dir))


def big_chances_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Big chances by match and passer."""
    return pas.big_chances_created(_passes(spark, sf_dir), _shots(spark, sf_dir))


def xa_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots by the pass that made them."""
    return rounded(pas.xa_targets(_shots(spark, sf_dir)))


_SHOT_FLAGS = tuple(c for c in sho.SHOT_FLAGS)


def derive_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots with flags, distance, angle and categories."""
    return rounded(_shots(spark, sf_dir).select(*_KEYS, *_SHOT_FLAGS, "distance_to_goal", "angle_to_goal", "body_part", "situation", "shot_location_name"))


def shot_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots with their distance on the pitch's own scale."""
    return rounded(sho.shot_subset(projected(spark, sf_dir, "match_events")).select(*_KEYS, "type_name", "distance_to_goal_pct"))


def shot_zone_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of all shots."""
    return rounded(sho.shot_zone_features(_shots(spark, sf_dir)).select(*_KEYS, *sho.ZONES[0]))


def _cols(*layers: dict) -> list[str]:
    return [c for layer in layers for c in layer]


def xg_base_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features of all shots."""
    made = sho.xg_base_features(_shots(spark, sf_dir))
    return rounded(made.select(*_KEYS, *_cols(*sho.BASE), "body_part_clean", "situation_clean", "shot_location_name_clean", "is_penalty_situation"))


def bucketize_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets of all shots."""
    return sho.bucketize_shots(sho.xg_base_features(_shots(spark, sf_dir))).select(*_KEYS, *sho.BUCKETS[0])


_CLIPPED = ["distance_to_goal", "angle_to_goal", "x", "y"]


def quantile_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots clipped to the 5 and 95 per cent bounds of the shots in scope."""
    shots = _shots(spark, sf_dir).select(*_KEYS, *_CLIPPED, "is_own_goal", "situation")
    return rounded(sho.quantile_clip(shots.where(sho.xg_scope(shots)), shots, _CLIPPED, 0.05, 0.95).select(*_KEYS, *_CLIPPED))


def goal_frame_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The goal frame seen by shots in scope."""
    shots = _shots(spark, sf_dir)
    return rounded(sho.goal_frame_params(shots.where(sho.xgot_scope(shots))))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    shots = _shots(spark, sf_dir)
    scope = shots.where(sho.xgot_scope(shots))
    return sho.xgot_placement_features(scope, sho.goal_frame_params(scope))


def xgot_placement_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of shots in scope."""
    return rounded(_placed(spark, sf_dir).select(*_KEYS, *_cols(*sho.PLACEMENT)))


def xgot_trajectory_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trajectory of shots in scope."""
    return rounded(sho.xgot_trajectory_features(_placed(spark, sf_dir)).select(*_KEYS, *_cols(*sho.TRAJECTORY)))


def shot_scope_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes of all shots."""
    return sho.shot_scope_filters(_shots(spark, sf_dir)).select(*_KEYS, "in_xg_scope", "in_xgot_scope")


def shot_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots joined to the given predictions."""
    shots = _shots(spark, sf_dir)
    xg = shots.select(*_KEYS, "xg")
    xgot = shots.where(sho.xgot_scope(shots)).select(*_KEYS, "xgot")
    return rounded(sho.shot_predictions(shots.select(*_KEYS, "team_id"), xg, xgot, "given"))


def discipline_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards by match and player."""
    return sho.discipline_totals(projected(spark, sf_dir, "match_events"))


def shot_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missed big chances and own goals by match and player."""
    return rounded(sho.shot_adjustments(_shots(spark, sf_dir)))


def _keepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineups = projected(spark, sf_dir, "player_matches").where(F.upper("position_code").startswith("GK") & (F.coalesce("minutes", F.lit(0.0)) > 0))
    last = projected(spark, sf_dir, "match_events").groupBy("match_id").agg(F.greatest(F.max("expanded_minute"), F.lit(90)).alias("last_minute"))
    start = F.when(F.col("started") == 1, 0.0).otherwise(F.greatest(F.col("last_minute") - F.col("minutes"), F.lit(0.0)))
    return lineups.join(last, "match_id").select("match_id", "player_id", "team_id", start.alias("start_minute"), F.col("last_minute").cast("double").alias("end_minute"))


def goalkeeper_faced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goalkeepers faced."""
    return rounded(sho.goalkeeper_faced(_shots(spark, sf_dir), _keepers(spark, sf_dir)))


QUERIES = (
    qualifier_flags, derive_passes, pass_geometry_features, pass_totals, big_chances_created, xa_targets, derive_shots, shot_subset, shot_zone_features,
    xg_base_features, bucketize_shots, quantile_clip, goal_frame_params, xgot_placement_features, xgot_trajectory_features, shot_scope_filters,
    shot_predictions, discipline_totals, shot_adjustments, goalkeeper_faced,
)

_M = ctes("match_events")
_PASS_FLAG_SQL = """is_key_pass::BIGINT AS is_key_pass, is_assist::BIGINT AS is_assist, 0::BIGINT AS is_intentional_assist,
  (pass_kind = 'cross')::BIGINT AS is_cross, (pass_kind = 'through_ball')::BIGINT AS is_through_ball, (pass_kind = 'long_ball')::BIGINT AS is_long_ball,
  (pass_kind = 'corner' OR situation = 'FromCorner')::BIGINT AS is_corner, (pass_kind = 'free_kick')::BIGINT AS is_free_kick,
  (pass_kind = 'throw_in')::BIGINT AS is_throw_in, (pass_kind = 'goal_kick')::BIGINT AS is_goal_kick"""
PASSES = f"""
passes AS (
  SELECT match_id, team_id, event_id, player_id, x, y, end_x, end_y, (outcome_name = 'Successful')::BIGINT AS success, {_PASS_FLAG_SQL},
         sqrt(pow((end_x - x) * 1.05, 2) + pow((end_y - y) * 0.68, 2)) AS pass_length, atan2((end_y - y) * 0.68, (end_x - x) * 1.05) AS pass_angle
  FROM match_events WHERE type_name = 'Pass')"""
SHOTS = """
shots AS (
  SELECT match_id, event_id, team_id, player_id, type_name, x, y, expanded_minute, is_goal, is_own_goal::BIGINT AS is_own_goal, related_event_id,
         goal_mouth_y, goal_mouth_z, xg_given AS xg, CASE WHEN goal_mouth_y IS NOT NULL THEN xg_given / 2 END AS xgot,
         CASE body_part WHEN 'Head' THEN 'Head' WHEN 'LeftFoot' THEN 'LeftFoot' WHEN 'RightFoot' THEN 'RightFoot' ELSE 'OtherBodyPart' END AS body_part, situation,
         CASE WHEN x >= 94 THEN 'SixYardBox' WHEN x >= 83 THEN 'PenaltyArea' ELSE 'OutOfBox' END AS shot_location_name,
         (body_part = 'Head')::BIGINT AS is_header, (body_part = 'RightFoot')::BIGINT AS is_right_foot, (body_part = 'LeftFoot')::BIGINT AS is_left_foot,
         (body_part = 'OtherBodyPart')::BIGINT AS is_other_body_part, (situation = 'Penalty')::BIGINT AS is_penalty, 0::BIGINT AS is_direct_free_kick,
         (situation = 'FromCorner')::BIGINT AS is_from_corner, (situation = 'SetPiece')::BIGINT AS is_set_piece, (situation = 'FastBreak')::BIGINT AS is_fast_break,
         (related_event_id IS NOT NULL)::BIGINT AS assisted, 0::BIGINT AS intentional_assist,
         sqrt(pow(105 - x * 1.05, 2) + pow(34 - y * 0.68, 2)) AS distance_to_goal,
         abs(atan2(7.32 * (105 - x * 1.05), pow(105 - x * 1.05, 2) + pow(34 - y * 0.68, 2) - pow(3.66, 2))) AS angle_to_goal
  FROM match_events WHERE is_shot = 1),
scope AS (
  SELECT *, is_own_goal = 0 AND situation NOT ILIKE '%pen%' AND x IS NOT NULL AND y IS NOT NULL AS in_xg FROM shots),
aimed AS (SELECT * FROM scope WHERE in_xg AND type_name IN ('Goal', 'SavedShot', 'ShotOnPost') AND goal_mouth_y IS NOT NULL AND goal_mouth_z IS NOT NULL),
frame AS (
  SELECT quantile_disc(goal_mouth_y, 0.01) AS gm_y_low, quantile_disc(goal_mouth_y, 0.5) AS gm_y_center, quantile_disc(goal_mouth_y, 0.99) AS gm_y_high,
         quantile_disc(goal_mouth_z, 0.99) AS gm_z_high, greatest(quantile_disc(goal_mouth_y, 0.99) - quantile_disc(goal_mouth_y, 0.5),
         quantile_disc(goal_mouth_y, 0.5) - quantile_disc(goal_mouth_y, 0.01)) AS gm_y_half_width, 0.0::DOUBLE AS gm_z_low FROM aimed)"""
_FRAMED = "(SELECT * FROM aimed, frame)"
_S = f"WITH {_M}, {SHOTS}"


def _doubles(*layers: dict) -> list[str]:
    return [c for layer in layers for c, e in layer.items() if not e.startswith("CASE WHEN") or c in ("gm_y_norm", "gm_z_norm", "centrality_score")]


def _integer(names: list[str]) -> str:
    return ", ".join(names)


KEEPERS = """
keepers AS (
  SELECT p.match_id, p.player_id, p.team_id, l.last_minute, CASE WHEN started = 1 THEN 0 ELSE greatest(l.last_minute - minutes, 0) END AS start_minute
  FROM player_matches p JOIN (SELECT match_id, greatest(max(expanded_minute), 90) AS last_minute FROM match_events GROUP BY match_id) l ON l.match_id = p.match_id
  WHERE position_code LIKE 'GK%' AND coalesce(minutes, 0) > 0),
faced AS (
  SELECT s.match_id, s.event_id, min(k.player_id) AS player_id, any_value(s.is_goal) AS is_goal, any_value(s.type_name) AS type_name, any_value(s.xgot) AS xgot
  FROM shots s JOIN keepers k ON k.match_id = s.match_id AND k.team_id <> s.team_id AND s.expanded_minute BETWEEN k.start_minute AND greatest(k.last_minute, k.start_minute)
  WHERE s.is_own_goal = 0 GROUP BY s.match_id, s.event_id),
goalkeeping AS (
  SELECT k.match_id, k.player_id, count(*) FILTER (WHERE is_goal = 1 OR xgot IS NOT NULL OR type_name = 'SavedShot') AS shots_on_target_faced,
         count(*) FILTER (WHERE is_goal = 1) AS goals_conceded, coalesce(sum(xgot), 0) AS xgot_faced,
         count(*) FILTER (WHERE is_goal = 1 AND xgot IS NOT NULL) AS goals_conceded_xgot_sample
  FROM keepers k LEFT JOIN faced f ON f.match_id = k.match_id AND f.player_id = k.player_id GROUP BY k.match_id, k.player_id)"""
PASS_TOTALS = """
pass_totals AS (
  SELECT match_id, player_id, count(*) FILTER (WHERE o) AS passes, count(*) FILTER (WHERE o AND success = 1) AS completed_passes,
         count(*) FILTER (WHERE o AND is_key_pass = 1) AS key_passes,
         count(*) FILTER (WHERE o AND success = 1 AND ((x < 50 AND end_x < 50 AND end_x - x >= 28.6) OR (x < 50 AND end_x >= 50 AND end_x - x >= 14.3)
                                                       OR (x >= 50 AND end_x - x >= 9.5))) AS progressive_passes, sum(is_assist)::BIGINT AS assists
  FROM (SELECT *, is_corner + is_free_kick + is_throw_in + is_goal_kick = 0 AS o FROM passes) GROUP BY match_id, player_id)"""
CREATED = """
created AS (
  SELECT p.match_id, p.player_id, count(*) AS big_chances_created FROM shots s JOIN passes p
  ON p.match_id = s.match_id AND p.team_id = s.team_id AND p.event_id = s.related_event_id WHERE s.xg >= 0.3 GROUP BY p.match_id, p.player_id)"""
CARDS = """
cards AS (
  SELECT match_id, player_id, count(*) FILTER (WHERE card_type = 'Yellow') AS yellow_cards, count(*) FILTER (WHERE card_type IN ('Red', 'Second Yellow')) AS red_cards
  FROM match_events GROUP BY match_id, player_id)"""
ADJUSTED = """
adjusted AS (
  SELECT match_id, player_id, count(*) FILTER (WHERE xg >= 0.3 AND is_goal = 0) AS big_chances_missed,
         coalesce(sum(xg) FILTER (WHERE xg >= 0.3 AND is_goal = 0), 0) AS big_chance_xg_missed, sum(is_own_goal)::BIGINT AS own_goals
  FROM shots GROUP BY match_id, player_id)"""

ORACLES = {
    "qualifier_flags": f"WITH {_M} SELECT match_id, event_id, {_PASS_FLAG_SQL} FROM match_events",
    "derive_passes": rounded_sql(f"WITH {_M}, {PASSES} SELECT match_id, event_id, success, {_integer(list(_FLAGS))}, pass_length, pass_angle FROM passes", ["pass_length", "pass_angle"]),
    "pass_geometry_features": rounded_sql(
        f"WITH {_M}, {PASSES} SELECT match_id, event_id, {', '.join((*pas.NUMERIC, *pas.CATEGORIES))} FROM {layered_sql('passes', pas.GEOMETRY)} AS g",
        [c for c in pas.NUMERIC if not c.startswith(("ends_", "enters_", "is_"))],
    ),
    "pass_totals": f"WITH {_M}, {PASSES}, {PASS_TOTALS} SELECT * FROM pass_totals",
    "big_chances_created": f"{_S}, {PASSES}, {CREATED} SELECT * FROM created",
    "xa_targets": rounded_sql(f"""{_S} SELECT match_id, team_id, related_event_id AS event_id, count(*) AS linked_shots, sum(xg) AS xa_target,
        sum(is_goal)::BIGINT AS goals_created, 1::BIGINT AS shot_created FROM shots WHERE related_event_id > 0 GROUP BY match_id, team_id, related_event_id""", ["xa_target"]),
    "derive_shots": rounded_sql(f"{_S} SELECT match_id, event_id, {', '.join(_SHOT_FLAGS)}, distance_to_goal, angle_to_goal, body_part, situation, shot_location_name FROM shots", ["distance_to_goal", "angle_to_goal"]),
    "shot_subset": rounded_sql(f"WITH {_M} SELECT match_id, event_id, type_name, sqrt(pow(100 - x, 2) + pow(50 - y, 2)) AS distance_to_goal_pct FROM match_events WHERE is_shot = 1", ["distance_to_goal_pct"]),
    "shot_zone_features": rounded_sql(f"{_S} SELECT match_id, event_id, {', '.join(sho.ZONES[0])} FROM {layered_sql('shots', sho.ZONES)} AS g", ["penalty_spot_dist"]),
    "xg_base_features": rounded_sql(
        f"""{_S} SELECT match_id, event_id, {', '.join(_cols(*sho.BASE))}, body_part AS body_part_clean, situation AS situation_clean,
        shot_location_name AS shot_location_name_clean, situation ILIKE '%pen%' AS is_penalty_situation FROM {layered_sql('shots', (*sho.ZONES, *sho.BASE))} AS g""",
        _cols(*sho.BASE),
    ),
    "bucketize_shots": f"{_S} SELECT match_id, event_id, {', '.join(sho.BUCKETS[0])} FROM {layered_sql('shots', (*sho.ZONES, *sho.BASE, *sho.BUCKETS))} AS g",
    "quantile_clip": rounded_sql(
        f"""{_S}, q AS (SELECT {', '.join(f'quantile_disc({c}, 0.05) AS {c}_lo, quantile_disc({c}, 0.95) AS {c}_hi' for c in _CLIPPED)} FROM scope WHERE in_xg)
        SELECT match_id, event_id, {', '.join(f'greatest(least({c}, {c}_hi), {c}_lo) AS {c}' for c in _CLIPPED)} FROM shots, q""", _CLIPPED),
    "goal_frame_params": f"{_S} SELECT * FROM frame",
    "xgot_placement_features": rounded_sql(f"{_S} SELECT match_id, event_id, {', '.join(_cols(*sho.PLACEMENT))} FROM {layered_sql(_FRAMED, sho.PLACEMENT)} AS g", [c for c in _cols(*sho.PLACEMENT) if not c.startswith("is_")]),
    "xgot_trajectory_features": rounded_sql(
        f"{_S} SELECT match_id, event_id, {', '.join(_cols(*sho.TRAJECTORY))} FROM {layered_sql(_FRAMED, (*sho.PLACEMENT, *sho.TRAJECTORY))} AS g",
        [c for c in _cols(*sho.TRAJECTORY) if not c.startswith(("is_", "across", "near", "shot_side", "goal_side"))],
    ),
    "shot_scope_filters": f"{_S} SELECT s.match_id, s.event_id, s.in_xg::BIGINT AS in_xg_scope, (a.event_id IS NOT NULL)::BIGINT AS in_xgot_scope FROM scope s LEFT JOIN aimed a ON a.match_id = s.match_id AND a.event_id = s.event_id",
    "shot_predictions": rounded_sql(f"""{_S} SELECT s.match_id, s.event_id, s.team_id, s.xg, a.xgot, (a.xgot IS NOT NULL)::BIGINT AS xgot_available, 'given' AS shot_model_version
        FROM shots s LEFT JOIN aimed a ON a.match_id = s.match_id AND a.event_id = s.event_id""", ["xg", "xgot"]),
    "discipline_totals": f"WITH {_M}, {CARDS} SELECT * FROM cards",
    "shot_adjustments": rounded_sql(f"{_S}, {ADJUSTED} SELECT * FROM adjusted", ["big_chance_xg_missed"]),
    "goalkeeper_faced": rounded_sql(f"WITH {ctes('player_matches')}, {SHOTS}, {KEEPERS} SELECT * FROM goalkeeping", ["xgot_faced"]),
}
