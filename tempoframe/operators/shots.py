"""Shots: derived flags, zones, buckets, clipping, goal frame, placement and trajectory features, scopes and per-player totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoframe.functions.expressions import clip, layered, non_null_sum
from tempoframe.functions.ranks import quantiles
from tempoframe.operators.passes import qualifier_flags

# Qualifier names behind each shot flag.
SHOT_FLAGS = {
    "is_header": ("Head",),
    "is_right_foot": ("RightFoot",),
    "is_left_foot": ("LeftFoot",),
    "is_other_body_part": ("OtherBodyPart",),
    "is_penalty": ("Penalty",),
    "is_direct_free_kick": ("DirectFreekick",),
    "is_from_corner": ("FromCorner",),
    "is_set_piece": ("SetPiece",),
    "is_fast_break": ("FastBreak",),
    "is_own_goal": ("OwnGoal",),
    "assisted": ("Assisted", "IntentionalAssist"),
    "intentional_assist": ("IntentionalAssist",),
}
ON_TARGET = ("Goal", "SavedShot", "ShotOnPost")
#: Fixed goal probabilities of penalties and own goals.
PENALTY_XG, OWN_GOAL_XG = 0.776, 0.0


def _first(flags: dict[str, str], otherwise: str) -> Column:
    c: Column | None = None
    for flag, label in flags.items():
        hit = F.col(flag) == 1
        c = F.when(hit, label) if c is None else c.when(hit, label)
    return c.otherwise(otherwise)


def goal_geometry(shots: DataFrame) -> DataFrame:
    """Adds ``distance_to_goal`` in metres and ``angle_to_goal`` in radians."""
    dx, dy = 105 - F.col("x") * 1.05, 34 - F.col("y") * 0.68
    angle = F.abs(F.atan2(dx * 7.32, dx * dx + dy * dy - 3.66 * 3.66))
    return shots.withColumns({"distance_to_goal": F.hypot(dx, dy), "angle_to_goal": angle})


def derive_shots(events: DataFrame) -> DataFrame:
    """Shots with their flags, distance and angle, body part, situation and location."""
    have = [c for c in SHOT_FLAGS if c in events.columns]
    shots = events.where(F.col("is_shot") == 1)
    shots = qualifier_flags(shots, {c: n for c, n in SHOT_FLAGS.items() if c not in have})
    shots = shots.withColumns({c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for c in have})
    x = F.col("x")
    return goal_geometry(shots).withColumns(
        {
            "body_part": _first({"is_header": "Head", "is_left_foot": "LeftFoot", "is_right_foot": "RightFoot"}, "OtherBodyPart"),
            "situation": _first(
                {
                    "is_penalty": "Penalty", "is_direct_free_kick": "DirectFreekick", "is_from_corner": "FromCorner",
                    "is_set_piece": "SetPiece", "is_fast_break": "FastBreak",
                },
                "RegularPlay",
            ),
            "shot_location_name": F.when(x >= 94, "SixYardBox").when(x >= 83, "PenaltyArea").otherwise("OutOfBox"),
        }
    )


def shot_subset(events: DataFrame) -> DataFrame:
    """Shots with ``distance_to_goal_pct``: distance to (100, 50) on the 0 to 100 scale."""
    return events.where(F.col("is_shot") == 1).withColumn("distance_to_goal_pct", F.hypot(100 - F.col("x"), 50 - F.col("y")))


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


# Zone limits and feature formulas that results depend on.
_INSIDE = "x >= 83 AND y BETWEEN 20 AND 80"
ZONES = (
    {
        "is_inside_box": _flag(_INSIDE),
        "is_six_yard_box": _flag("x >= 94 AND y BETWEEN 36 AND 64"),
        "is_zone_14": _flag("x >= 77 AND x < 83 AND y BETWEEN 36 AND 64"),
        "is_central_box": _flag(f"{_INSIDE} AND y BETWEEN 36 AND 64"),
        "is_wide_box": _flag(f"{_INSIDE} AND NOT y BETWEEN 36 AND 64"),
        "penalty_spot_dist": "sqrt((x - 89.5) * (x - 89.5) + (y - 50) * (y - 50))",
        "is_penalty_spot_zone": _flag("(x - 89.5) * (x - 89.5) + (y - 50) * (y - 50) <= 25"),
    },
)
BASE = (
    {
        "log_distance": "ln(1 + distance_to_goal)",
        "inverse_distance": "1 / (distance_to_goal + 1e-6)",
        "abs_y_from_center": "abs(y - 50)",
        "centrality_score": "CASE WHEN y IS NOT NULL THEN least(greatest(1 - abs(y - 50) / 50, 0), 1) END",
        "distance_angle_ratio": "angle_to_goal / (distance_to_goal + 1e-6)",
    },
    {
        **{f"{m}_{z}": f"{m}_to_goal * {c}" for m in ("angle", "distance") for z, c in (("inside_box", "is_inside_box"), ("outside_box", "(1 - is_inside_box)"), ("six_yard_box", "is_six_yard_box"), ("zone_14", "is_zone_14"))},
        "central_close": "is_central_box * inverse_distance",
        "wide_angle_penalty": "is_wide_box * angle_to_goal",
        "six_yard_central": "is_six_yard_box * centrality_score",
        "box_centrality": "is_inside_box * centrality_score",
    },
)


def _ladder(column: str, steps: list[tuple[float, str]], last: str) -> str:
    return "CASE " + " ".join(f"WHEN {column} <= {top} THEN '{name}'" for top, name in steps) + f" ELSE '{last}' END"


#: Right-closed buckets.
BUCKETS = (
    {
        "distance_bucket": _ladder(
            "distance_to_goal",
            [(3, "0_3"), (6, "3_6"), (9, "6_9"), (12, "9_12"), (15, "12_15"), (18, "15_18"), (21, "18_21"), (24, "21_24"), (30, "24_30"), (40, "30_40")],
            "40_plus",
        ),
        "angle_bucket": _ladder(
            "angle_to_goal", [(0.15, "0_015"), (0.30, "015_030"), (0.50, "030_050"), (0.75, "050_075"), (1.00, "075_100"), (1.25, "100_125")], "125_plus"
        ),
        "centrality_bucket": _ladder(
            "centrality_score", [(0.40, "0_040"), (0.60, "040_060"), (0.75, "060_075"), (0.85, "075_085"), (0.92, "085_092"), (0.97, "092_097")], "097_100"
        ),
    },
)


def shot_zone_features(shots: DataFrame) -> DataFrame:
    """Adds zone flags; a null coordinate is in no zone."""
    return layered(shots, ZONES)


def xg_base_features(shots: DataFrame) -> DataFrame:
    """Adds zones, distance and angle transforms, their interactions and ``is_penalty_situation``."""
    named = {f"{c}_clean": F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in ("body_part", "situation", "shot_location_name") if c in shots.columns}
    made = layered(layered(shots.withColumns(named), ZONES), BASE)
    return made.withColumn("is_penalty_situation", F.lower("situation_clean").contains("pen"))


def bucketize_shots(shots: DataFrame) -> DataFrame:
    """Adds the distance, angle and centrality buckets; nulls fall into the last."""
    return layered(shots, BUCKETS)


def quantile_bounds(shots: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999) -> DataFrame:
    """One row of ``<column>_lo`` and ``<column>_hi``: elements at the quantiles (the first that is not below), nulls left out."""
    return quantiles(shots, {f"{c}_{n}": (c, q) for c in columns for n, q in (("lo", low), ("hi", high))}, discrete=True)


def quantile_clip(scope: DataFrame, shots: DataFrame, columns: list[str], low: float = 0.001, high: float = 0.999) -> DataFrame:
    """``shots`` with columns held within the quantile bounds of ``scope``; without values there the column stays as it is."""
    return clip_to(shots, quantile_bounds(scope, columns, low, high), columns)


def clip_to(shots: DataFrame, bounds: DataFrame, columns: list[str]) -> DataFrame:
    """``shots`` with columns held within the one row of ``bounds``."""
    joined = shots.crossJoin(F.broadcast(bounds))  # one row
    held = {c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.col(f"{c}_hi")), F.col(f"{c}_lo"))) for c in columns}
    return joined.withColumns(held).select(*shots.columns)


def goal_frame_params(shots: DataFrame) -> DataFrame:
    """One row: centre, low, high and half width of the goal mouth in y and its height in z."""
    y, z = "goal_mouth_y", "goal_mouth_z"
    row = quantiles(shots, {"gm_y_low": (y, 0.01), "gm_y_center": (y, 0.5), "gm_y_high": (y, 0.99), "gm_z_high": (z, 0.99)}, discrete=True)
    half = F.greatest(F.col("gm_y_high") - F.col("gm_y_center"), F.col("gm_y_center") - F.col("gm_y_low"))
    return row.withColumns({"gm_y_half_width": half, "gm_z_low": F.lit(0.0)})


def _corner(y: int, z: int) -> str:
    return f"sqrt((gm_y_norm - {y}) * (gm_y_norm - {y}) + (gm_z_norm - {z}) * (gm_z_norm - {z}))"


#: Where a shot enters the goal frame; reads ``xg`` and the columns of ``goal_frame_params``.
PLACEMENT = (
    {
        "gm_y_centered": "goal_mouth_y - gm_y_center",
        "gm_y_norm": "CASE WHEN goal_mouth_y IS NOT NULL THEN least(greatest((goal_mouth_y - gm_y_center) / gm_y_half_width, -1.5), 1.5) END",
        "gm_z_norm": "CASE WHEN goal_mouth_z IS NOT NULL THEN least(greatest(goal_mouth_z / gm_z_high, 0), 1.25) END",
    },
    {
        "abs_gm_y_centered": "abs(gm_y_centered)",
        "abs_gm_y_norm": "abs(gm_y_norm)",
        "placement_dist_from_center": "sqrt(gm_y_norm * gm_y_norm + (gm_z_norm - 0.5) * (gm_z_norm - 0.5))",
        "dist_to_nearest_post": "least(abs(gm_y_norm + 1), abs(gm_y_norm - 1))",
        "dist_bottom_left": _corner(-1, 0), "dist_bottom_right": _corner(1, 0), "dist_top_left": _corner(-1, 1), "dist_top_right": _corner(1, 1),
    },
    {
        "dist_to_nearest_corner": "least(dist_bottom_left, dist_bottom_right, dist_top_left, dist_top_right)",
        "dist_to_nearest_top_corner": "least(dist_top_left, dist_top_right)",
        "dist_to_nearest_bottom_corner": "least(dist_bottom_left, dist_bottom_right)",
        "is_central_placement": _flag("abs_gm_y_norm <= 0.25"),
        "is_wide_placement": _flag("abs_gm_y_norm >= 0.7"),
        "is_high_placement": _flag("gm_z_norm >= 0.7"),
        "is_low_placement": _flag("gm_z_norm <= 0.25"),
    },
    {
        "is_top_corner_placement": "is_wide_placement * is_high_placement",
        "is_bottom_corner_placement": "is_wide_placement * is_low_placement",
    },
    {
        "xg_top_corner": "xg * is_top_corner_placement",
        "xg_bottom_corner": "xg * is_bottom_corner_placement",
        "xg_central_placement": "xg * is_central_placement",
        "xg_placement_dist": "xg * placement_dist_from_center",
    },
)
#: How a shot gets there; reads the placement columns and ``distance_to_goal``.
TRAJECTORY = (
    {
        "shot_y_centered": "y - 50",
        "shot_side_sign": "CASE WHEN y > 50 THEN 1 WHEN y < 50 THEN -1 ELSE 0 END",
        "goal_side_sign": "CASE WHEN gm_y_centered > 0 THEN 1 WHEN gm_y_centered < 0 THEN -1 ELSE 0 END",
        "shot_to_goal_lateral_delta": "gm_y_norm - least(greatest((y - 50) / 50, -1), 1)",
        "vertical_lift_per_distance": "gm_z_norm / (distance_to_goal + 1e-6)",
        "wide_placement_per_distance": "abs_gm_y_norm / (distance_to_goal + 1e-6)",
        "placement_dist_per_distance": "placement_dist_from_center / (distance_to_goal + 1e-6)",
        "vertical_trajectory_angle": "atan2(gm_z_norm, distance_to_goal + 1e-6)",
    },
    {
        "abs_shot_to_goal_lateral_delta": "abs(shot_to_goal_lateral_delta)",
        "is_across_goal": _flag("shot_side_sign * goal_side_sign = -1"),
        "is_near_side_finish": _flag("shot_side_sign * goal_side_sign = 1"),
        "lateral_trajectory_angle": "atan2(abs(shot_to_goal_lateral_delta), distance_to_goal + 1e-6)",
    },
    {
        "across_goal_wide": "is_across_goal * is_wide_placement",
        "near_side_wide": "is_near_side_finish * is_wide_placement",
        "across_goal_low": "is_across_goal * is_low_placement",
        "across_goal_high": "is_across_goal * is_high_placement",
        "xg_across_goal": "xg * is_across_goal",
        "xg_near_side": "xg * is_near_side_finish",
        "xg_vertical_angle": "xg * vertical_trajectory_angle",
        "xg_lateral_angle": "xg * lateral_trajectory_angle",
        "xg_placement_dist_per_distance": "xg * placement_dist_per_distance",
    },
)


def xgot_placement_features(shots: DataFrame, frame: DataFrame) -> DataFrame:
    """Adds placement features; ``frame`` is the row of ``goal_frame_params``."""
    return layered(shots.crossJoin(F.broadcast(frame)), PLACEMENT).drop(*frame.columns)  # one row


def xgot_trajectory_features(placed: DataFrame) -> DataFrame:
    """Adds trajectory features to shots with placement features."""
    return layered(placed, TRAJECTORY)


def xg_scope(shots: DataFrame) -> Column:
    """Neither own goal nor penalty, with both coordinates."""
    return (F.coalesce(F.col("is_own_goal"), F.lit(0)) == 0) & ~F.coalesce(F.lower("situation").contains("pen"), F.lit(False)) & F.col("x").isNotNull() & F.col("y").isNotNull()


def xgot_scope(shots: DataFrame) -> Column:
    """In scope for xG and on target with a goal-mouth point."""
    return xg_scope(shots) & F.col("type_name").isin(*ON_TARGET) & F.col("goal_mouth_y").isNotNull() & F.col("goal_mouth_z").isNotNull()


def shot_scope_filters(shots: DataFrame) -> DataFrame:
    """Shots with 0/1 columns ``in_xg_scope`` and ``in_xgot_scope``."""
    return shots.withColumns({"in_xg_scope": xg_scope(shots).cast("long"), "in_xgot_scope": F.coalesce(xgot_scope(shots), F.lit(False)).cast("long")})


def shot_predictions(shots: DataFrame, xg: DataFrame, xgot: DataFrame, version: str, keys: tuple[str, ...] = ("match_id", "event_id")) -> DataFrame:
    """Shots with ``xg``, ``xgot``, ``xgot_available`` (0/1) and ``shot_model_version``; the first prediction of a key counts."""
    k = list(keys)
    made = shots.join(xg.groupBy(*k).agg(F.min("xg").alias("xg")), k, "left").join(xgot.groupBy(*k).agg(F.min("xgot").alias("xgot")), k, "left")
    return made.withColumns({"xgot_available": F.col("xgot").isNotNull().cast("long"), "shot_model_version": F.lit(version)})


def discipline_totals(events: DataFrame) -> DataFrame:
    """Yellow and red cards by match and player, from the letters of ``card_type``; a second yellow counts as red."""
    card = F.regexp_replace(F.lower(F.coalesce("card_type", F.lit(""))), "[^a-z]", "")
    return (
        events.dropna(subset=["match_id", "player_id"])
        .groupBy("match_id", "player_id")
        .agg(
            F.count_if(card.contains("yellow") & ~card.contains("secondyellow")).alias("yellow_cards"),
            F.count_if(card.rlike("red|secondyellow")).alias("red_cards"),
        )
    )


def shot_adjustments(shots: DataFrame, xg: str = "xg", least: float = 0.30) -> DataFrame:
    """Missed big chances, their xG and own goals by match and player."""
    value = F.coalesce(F.col(xg), F.lit(0.0))
    missed = (value >= least) & (F.coalesce(F.col("is_goal"), F.lit(0)) == 0)
    return (
        shots.dropna(subset=["match_id", "player_id"])
        .groupBy("match_id", "player_id")
        .agg(
            F.count_if(missed).alias("big_chances_missed"),
            non_null_sum(F.when(missed, value)).alias("big_chance_xg_missed"),
            non_null_sum(F.coalesce(F.col("is_own_goal"), F.lit(0)).cast("long")).alias("own_goals"),
        )
    )


def shot_totals(shots: DataFrame, xg: str = "xg", xgot: str = "xgot") -> DataFrame:
    """Shots, goals, xG and xGOT by match and player; own goals are rows like others."""
    return (
        shots.dropna(subset=["match_id", "player_id"])
        .groupBy("match_id", "player_id")
        .agg(F.count("*").alias("shots"), non_null_sum("is_goal").alias("goals"), non_null_sum(xg).alias("xg"), non_null_sum(xgot).alias("xgot"))
    )


def goalkeeper_faced(shots: DataFrame, keepers: DataFrame, xgot: str = "xgot") -> DataFrame:
    """Totals of what each goalkeeper faced while on the pitch.

    ``keepers`` has ``match_id, player_id, team_id, start_minute, end_minute``. A shot goes to the keeper of the other team
    whose interval holds its minute, of several to the smallest player_id; own goals count for nobody. Goals, saved shots and shots with
    xGOT are on target. Keepers that faced nothing have zeros.
    """
    faced = shots.where(F.coalesce(F.col("is_own_goal"), F.lit(0)) == 0).select(
        "match_id", F.col("team_id").alias("shooting"), "event_id", F.coalesce(F.col("is_goal"), F.lit(0)).alias("goal"), "type_name",
        F.col(xgot).alias("xgot"), F.coalesce("expanded_minute", F.lit(0)).alias("minute"),
    )
    own = keepers.select("match_id", "player_id", "team_id", "start_minute", "end_minute")
    hit = faced.join(
        own, ["match_id"]
    ).where((F.col("team_id") != F.col("shooting")) & F.col("minute").between(F.col("start_minute"), F.greatest("end_minute", "start_minute")))
    one = hit.groupBy("match_id", "shooting", "event_id").agg(
        F.min("player_id").alias("player_id"), F.first("goal").alias("goal"), F.first("type_name").alias("type_name"), F.first("xgot").alias("xgot")
    )
    seen, goal = F.col("xgot").isNotNull(), F.col("goal") == 1
    sums = one.groupBy("match_id", "player_id").agg(
        F.count_if(goal | seen | F.lower("type_name").rlike("saved ?shot")).alias("shots_on_target_faced"),
        F.count_if(goal).alias("goals_conceded"),
        non_null_sum("xgot").alias("xgot_faced"),
        F.count_if(goal & seen).alias("goals_conceded_xgot_sample"),
    )
    return own.select("match_id", "player_id").distinct().join(sums, ["match_id", "player_id"], "left").fillna(0)
