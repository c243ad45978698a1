"""Passes: derived flags, geometry features and per-player totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoframe.functions.expressions import layered, non_null_sum

# Qualifier names behind each pass flag.
PASS_FLAGS = {
    "is_key_pass": ("KeyPass",),
    "is_assist": ("Assist", "IntentionalAssist"),
    "is_intentional_assist": ("IntentionalAssist",),
    "is_cross": ("Cross",),
    "is_through_ball": ("Throughball", "ThroughBall"),
    "is_long_ball": ("Longball", "LongBall"),
    "is_corner": ("CornerTaken", "FromCorner"),
    "is_free_kick": ("FreekickTaken", "FreeKickTaken"),
    "is_throw_in": ("ThrowIn",),
    "is_goal_kick": ("GoalKick",),
}
SET_PIECES = ("is_corner", "is_free_kick", "is_throw_in", "is_goal_kick")


def qualifier_flags(events: DataFrame, flags: dict[str, tuple[str, ...]], names: str = "qualifier_names") -> DataFrame:
    """Adds a 0/1 column for each flag: whether any of its qualifier names is in the array column ``names``; a null array has none."""
    def flag(wanted: tuple[str, ...]) -> Column:
        return F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, wanted))), F.lit(False)).cast("long")

    return events.withColumns({c: flag(wanted) for c, wanted in flags.items()})


def derive_passes(events: DataFrame) -> DataFrame:
    """Passes with ``success``, the pass flags, length and angle in metres."""
    flagged = qualifier_flags(events.where(F.col("type_name") == "Pass"), PASS_FLAGS)
    done = F.lower("outcome_name") == "successful"
    if "outcome_value" in events.columns:
        done = (F.col("outcome_value") == 1) | done
    dx, dy = (F.col("end_x") - F.col("x")) * 1.05, (F.col("end_y") - F.col("y")) * 0.68
    return flagged.withColumns(
        {"success": F.coalesce(done, F.lit(False)).cast("long"), "pass_length": F.hypot(dx, dy), "pass_angle": F.atan2(dy, dx)}
    )


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


_END_BOX, _START_BOX = "(end_x >= 85 AND end_y BETWEEN 22.5 AND 77.5)", "(x >= 85 AND y BETWEEN 22.5 AND 77.5)"


def _thirds(x: str) -> str:
    return f"CASE WHEN {x} < 33.3 THEN 'defensive_third' WHEN {x} < 66.7 THEN 'middle_third' ELSE 'final_third' END"


#: Areas, thresholds and geometry of a pass, in layers; the goal is at (105, 34) metres and 7.32 wide.
GEOMETRY = (
    {"dx": "end_x - x", "dy": "end_y - y", "dx_m": "1.05 * (end_x - x)", "dy_m": "0.68 * (end_y - y)", "goal_dx": "105 - 1.05 * end_x", "goal_dy": "34 - 0.68 * end_y"},
    {
        "pass_distance_100": "sqrt(dx * dx + dy * dy)",
        "pass_distance_m": "sqrt(dx_m * dx_m + dy_m * dy_m)",
        "forward_progress_100": "dx",
        "forward_progress_m": "dx_m",
        "lateral_movement_100": "abs(dy)",
        "lateral_movement_m": "abs(dy_m)",
        "start_abs_y_from_center": "abs(y - 50)",
        "end_abs_y_from_center": "abs(end_y - 50)",
        "end_centrality": "50 - abs(end_y - 50)",
        "start_distance_to_goal_m": "sqrt((105 - 1.05 * x) * (105 - 1.05 * x) + (34 - 0.68 * y) * (34 - 0.68 * y))",
        "end_distance_to_goal_m": "sqrt(goal_dx * goal_dx + goal_dy * goal_dy)",
        "end_angle_to_goal": "abs(atan2(7.32 * goal_dx, goal_dx * goal_dx + goal_dy * goal_dy - 3.66 * 3.66))",
        "pass_angle_calc": "atan2(dy_m, dx_m)",
    },
    {
        "distance_to_goal_reduction_m": "start_distance_to_goal_m - end_distance_to_goal_m",
        "verticality": "dx_m / (pass_distance_m + 1e-9)",
        "horizontality": "abs(dy_m) / (pass_distance_m + 1e-9)",
        "pass_angle_sin": "sin(pass_angle_calc)",
        "pass_angle_cos": "cos(pass_angle_calc)",
        "ends_final_third": _flag("end_x >= 66.7"),
        "enters_final_third": _flag("x < 66.7 AND end_x >= 66.7"),
        "ends_in_box": _flag(_END_BOX),
        "enters_box": _flag(f"{_END_BOX} AND NOT {_START_BOX}"),
        "ends_zone14": _flag("end_x >= 66.7 AND end_x < 85 AND end_y BETWEEN 35 AND 65"),
        "ends_left_halfspace": _flag("end_x >= 66.7 AND end_y BETWEEN 18 AND 35"),
        "ends_right_halfspace": _flag("end_x >= 66.7 AND end_y BETWEEN 65 AND 82"),
        "ends_wide_final_third": _flag("end_x >= 66.7 AND (end_y < 18 OR end_y > 82)"),
        "is_cutback_proxy": _flag("x >= 85 AND (y <= 22.5 OR y >= 77.5) AND end_x <= x + 2 AND end_x >= 75 AND end_y BETWEEN 25 AND 75"),
        "is_switch_proxy": _flag("abs(dy) >= 35 AND sqrt(dx * dx + dy * dy) >= 35"),
        "start_third": _thirds("x"),
        "end_third": _thirds("end_x"),
        "end_channel": "CASE WHEN end_y < 18 THEN 'left_wide' WHEN end_y < 35 THEN 'left_halfspace' WHEN end_y <= 65 THEN 'central'"
        " WHEN end_y <= 82 THEN 'right_halfspace' ELSE 'right_wide' END",
    },
    {
        "pass_type": "CASE WHEN is_corner = 1 THEN 'corner' WHEN is_free_kick = 1 THEN 'free_kick' WHEN is_cross = 1 THEN 'cross'"
        " WHEN is_through_ball = 1 THEN 'through_ball' WHEN is_long_ball = 1 THEN 'long_ball' WHEN is_throw_in = 1 THEN 'throw_in'"
        " WHEN is_goal_kick = 1 THEN 'goal_kick' WHEN is_cutback_proxy = 1 THEN 'cutback_proxy' WHEN is_switch_proxy = 1 THEN 'switch_proxy'"
        " ELSE 'pass_other' END",
    },
)
#: What a model reads of a pass: where it starts and ends, its own length and angle, its flags and its geometry.
NUMERIC = (
    "x", "y", "end_x", "end_y", "pass_length", "pass_angle", "is_cross", "is_through_ball", "is_long_ball", "is_corner", "is_free_kick", "is_throw_in", "is_goal_kick",
    *(c for layer in GEOMETRY[:3] for c in layer if c not in ("goal_dx", "goal_dy", "start_third", "end_third", "end_channel")),
)
CATEGORIES = ("pass_type", "start_third", "end_third", "end_channel")


def pass_geometry_features(passes: DataFrame) -> DataFrame:
    """Adds the geometry features and categories to passes with start, end and flags; a null coordinate gives null measures and 0 flags."""
    return layered(passes, GEOMETRY).drop("goal_dx", "goal_dy")


def progressive_pass() -> Column:
    """Whether a pass gains 28.6 in the own half, 14.3 across the middle line or 9.5 in the other half."""
    gain, own = F.col("end_x") - F.col("x"), F.col("x") < 50
    there = F.col("end_x") < 50
    return F.coalesce((own & there & (gain >= 28.6)) | (own & ~there & (gain >= 14.3)) | (~own & (gain >= 9.5)), F.lit(False))


def pass_totals(passes: DataFrame) -> DataFrame:
    """Totals by match and player: open-play ``passes``, ``completed_passes``, ``key_passes``, ``progressive_passes``; ``assists`` of all passes.

    One conditional aggregate, equal to a full outer join of open-play totals and assists; null flags count as zero.
    """
    open_play = F.lit(True)
    for c in SET_PIECES:
        open_play = open_play & (F.coalesce(F.col(c), F.lit(0)) == 0)
    one = lambda ok: non_null_sum(F.when(open_play & ok, 1).otherwise(0))
    return (
        passes.dropna(subset=["match_id", "player_id"])
        .groupBy("match_id", "player_id")
        .agg(
            one(F.lit(True)).alias("passes"),
            one(F.col("success") == 1).alias("completed_passes"),
            one(F.col("is_key_pass") == 1).alias("key_passes"),
            one(progressive_pass() & (F.col("success") == 1)).alias("progressive_passes"),
            non_null_sum(F.col("is_assist").cast("long")).alias("assists"),
        )
    )


def big_chances_created(passes: DataFrame, shots: DataFrame, xg: str = "xg", least: float = 0.30) -> DataFrame:
    """Shots of at least ``least`` joined to the pass they name, counted by match and passer."""
    big = shots.where(F.coalesce(F.col(xg), F.lit(0.0)) >= least).select("match_id", "team_id", F.col("related_event_id").alias("event_id")).dropna()
    makers = passes.select("match_id", "team_id", "event_id", "player_id").dropna()
    return big.join(makers, ["match_id", "team_id", "event_id"]).groupBy("match_id", "player_id").agg(F.count("*").alias("big_chances_created"))


def xa_targets(shots: DataFrame, xg: str = "xg") -> DataFrame:
    """Shots by the pass they name (positive ``related_event_id``): how many, their xG and goals."""
    return (
        shots.where("related_event_id > 0")
        .groupBy("match_id", "team_id", F.col("related_event_id").alias("event_id"))
        .agg(
            F.count("*").alias("linked_shots"),
            non_null_sum(xg).alias("xa_target"),
            non_null_sum(F.coalesce(F.col("is_goal"), F.lit(0)).cast("long")).alias("goals_created"),
        )
        .withColumn("shot_created", F.lit(1).cast("long"))
    )
