"""Event sequences of matches: clocks, carries, defensive value, actions and value grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoframe.functions.expressions import clip

# Event types by role.
IGNORED = ("SubstitutionOff", "SubstitutionOn", "Card", "FormationChange")
CARRY_FROM = ("Pass", "TakeOn", "BallRecovery", "Interception", "Tackle", "KeeperPickup", "KeeperSweeper", "Clearance", "BlockedPass")
CARRY_TO = ("Pass", "Shot", "SavedShot", "MissedShots", "Goal", "TakeOn", "BallTouch", "Dispossessed")
DEFENSIVE = ("Tackle", "Interception", "BallRecovery", "Clearance", "BlockedPass", "Challenge", "Save", "KeeperPickup", "KeeperSweeper", "Aerial")
STOPPERS = ("Clearance", "Save", "KeeperPickup", "KeeperSweeper")

ACTION_COLUMNS = ("match_id", "team_id", "player_id", "period_value", "event_time_seconds", "event_id", "x", "y", "end_x", "end_y")


def event_clock(events: DataFrame) -> DataFrame:
    """Adds ``event_time_seconds`` and ``cumulative_mins`` from ``expanded_minute`` (else ``minute``) and ``second``; nulls count as zero."""
    has = events.columns
    minute = F.coalesce(*(F.col(c) for c in ("expanded_minute", "minute") if c in has), F.lit(0))
    second = F.coalesce(F.col("second").cast("double"), F.lit(0.0))
    seconds = minute.cast("double") * 60 + second
    return events.withColumns({"event_time_seconds": seconds, "cumulative_mins": seconds / 60})


def _metres(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot((x2 - x1) * 1.05, (y2 - y1) * 0.68)


def _goal_distance(x: Column, y: Column) -> Column:
    """Distance to the goal on a 120 by 80 pitch."""
    return F.hypot(120 - x * 1.2, 40 - y * 0.8)


def in_box(x: Column, y: Column) -> Column:
    """Whether a point is in the opponent's box of the carry and pass rules."""
    return (x >= 85) & y.between(22.5, 77.5)


def infer_carries(
    events: DataFrame, min_seconds: float = 1, max_seconds: float = 10, min_metres: float = 5, max_metres: float = 60
) -> DataFrame:
    """Carries between consecutive actions of a team, one row each.

    Events without match, team, player, period or time are left out. A carry starts where a successful action of ``CARRY_FROM``
    ended and goes to the next event of the period that counts: ignored types, tried take-ons, fouls and
    opponents' lost challenges are passed over. Ties in time are ordered by event_id. The sequence is one window sorted backwards, so that
    looking ahead costs one pass.
    """
    rows = events.dropna(subset=["match_id", "team_id", "player_id", "period_value", "event_time_seconds"])
    kind, outcome = F.col("type_name"), F.col("outcome_name")
    tried = (kind == "TakeOn") & outcome.isin("Successful", "Unsuccessful")
    lost = (kind == "Challenge") & (outcome == "Unsuccessful")
    passed = F.coalesce(kind.isin(*IGNORED) | tried | (kind == "Foul"), F.lit(False))
    lost = F.coalesce(lost, F.lit(False))
    dribble = F.coalesce((kind == "TakeOn") & (outcome == "Successful"), F.lit(False)).cast("long")
    uid = ["event_uid"] if "event_uid" in rows.columns else []  # orders events of one id, and names carries
    back = [F.col(c).desc() for c in ("event_time_seconds", "event_id", *uid)]
    whole = Window.partitionBy("match_id", "period_value").orderBy(*back)
    ahead, ahead_team = whole.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("match_id", "period_value", "team_id").orderBy(*back).rowsBetween(Window.unboundedPreceding, -1)
    here = F.struct(
        "event_time_seconds", "event_id", *uid, "team_id", "player_id", "type_name", "x", "y", F.col("_left").alias("dribbles_left")
    )
    name = lambda at: F.coalesce(*(at(c).cast("string") for c in (*uid, "event_id")))
    rows = rows.withColumn("_left", F.sum(dribble).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumns(
        {
            "_next": F.last(F.when(~passed & ~lost, here), ignorenulls=True).over(ahead),
            "_own": F.last(F.when(lost, F.struct("event_time_seconds", "event_id", *uid)), ignorenulls=True).over(ahead_team),
            "_after": F.lag("event_time_seconds").over(whole),
        }
    )
    n = F.col("_next")
    seconds = n["event_time_seconds"] - F.col("event_time_seconds")
    metres = _metres(F.col("end_x"), F.col("end_y"), n["x"], n["y"])
    blocked = F.coalesce(F.col("_own") < F.struct(*(n[c].alias(c) for c in ("event_time_seconds", "event_id", *uid))), F.lit(False))
    found = rows.where(
        kind.isin(*CARRY_FROM) & (outcome == "Successful") & F.col("end_x").isNotNull() & F.col("end_y").isNotNull()
        & n.isNotNull() & ~blocked & (n["team_id"] == F.col("team_id")) & n["type_name"].isin(*CARRY_TO)
        & n["x"].isNotNull() & n["y"].isNotNull() & F.col("event_id").isNotNull() & n["event_id"].isNotNull()
        & seconds.between(min_seconds, max_seconds) & metres.between(min_metres, max_metres)
    )
    x1, y1, x2, y2 = F.col("end_x"), F.col("end_y"), n["x"], n["y"]
    nearer = _goal_distance(x1, y1) - _goal_distance(x2, y2)
    ahead_half, far_half = x1 * 1.2 < 60, x2 * 1.2 >= 60
    progressive = (ahead_half & ~far_half & (nearer >= 32.8)) | (ahead_half & far_half & (nearer >= 16.4)) | (~ahead_half & far_half & (nearer >= 10.94))
    time = (F.col("event_time_seconds") + F.col("_after")) / 2
    return found.select(
        "match_id",
        (F.col("event_id") + 0.5).cast("double").alias("event_id"),
        F.concat(F.lit("carry:"), name(F.col), F.lit(":"), name(lambda c: n[c])).alias("event_uid"),
        F.col("event_id").alias("source_event_id"),
        n["event_id"].alias("target_event_id"),
        "period_value",
        time.cast("double").alias("event_time_seconds"),
        n["team_id"].alias("team_id"),
        n["player_id"].alias("player_id"),
        x1.alias("x"), y1.alias("y"), x2.alias("end_x"), y2.alias("end_y"),
        seconds.cast("double").alias("carry_duration_seconds"),
        metres.alias("carry_distance_m"),
        F.hypot(x2 - x1, y2 - y1).alias("carry_distance_100"),
        # what is left to come after this event, less what is left from the next one on
        (F.col("_left") - dribble - n["dribbles_left"]).alias("take_ons"),
        progressive.cast("long").alias("is_progressive_carry"),
        ((x1 < 66.7) & (x2 >= 66.7)).cast("long").alias("is_final_third_carry"),
        (~in_box(x1, y1) & in_box(x2, y2)).cast("long").alias("is_carry_into_box"),
    )


def opponent_map(events: DataFrame) -> DataFrame:
    """``match_id``, ``team_id`` and ``opponent_team_id`` of matches with exactly two teams; null teams do not count."""
    teams = events.groupBy("match_id").agg(F.collect_set("team_id").alias("t")).where(F.size("t") == 2)
    return teams.select("match_id", F.inline(F.array(
        F.struct(F.get("t", F.lit(0)).alias("team_id"), F.get("t", F.lit(1)).alias("opponent_team_id")),
        F.struct(F.get("t", F.lit(1)).alias("team_id"), F.get("t", F.lit(0)).alias("opponent_team_id")),
    )))


def zone_of(x: Column, y: Column, nx: int, ny: int) -> Column:
    """Grid cell of a point, counted along x first; null without a finite point."""
    ok = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    zx, zy = F.floor(clip(x, 0, 99.999) / 100 * nx), F.floor(clip(y, 0, 99.999) / 100 * ny)
    return F.when(ok, (zx + zy * nx).cast("long"))


def grid_zones(actions: DataFrame, nx: int = 12, ny: int = 8) -> DataFrame:
    """Adds ``start_zone`` and ``end_zone``."""
    return actions.withColumns(
        {
            "start_zone": zone_of(F.col("x"), F.col("y"), nx, ny),
            "end_zone": zone_of(F.col("end_x"), F.col("end_y"), nx, ny),
        }
    )


def grid_value_added(actions: DataFrame, grid: DataFrame, metric: str, nx: int = 12, ny: int = 8) -> DataFrame:
    """Adds the grid's value at start and end of each action, the difference, and its positive and negative part; no cell counts as zero.

    ``grid`` has ``zone`` and ``grid_value``, a row for each of ``nx * ny`` cells.
    """
    zoned = grid_zones(actions, nx, ny)
    for end in ("start", "end"):
        cells = grid.where((F.col("zone") >= 0) & (F.col("zone") < nx * ny)).select(
            F.col("zone").alias(f"{end}_zone"), F.col("grid_value").alias(f"{metric}_{end}")
        )
        zoned = zoned.join(F.broadcast(cells.dropDuplicates([f"{end}_zone"])), f"{end}_zone", "left")  # nx * ny rows
    zoned = zoned.fillna(0.0, [f"{metric}_start", f"{metric}_end"])
    added = F.col(f"{metric}_end") - F.col(f"{metric}_start")
    return zoned.withColumns(
        {
            f"{metric}_added": added,
            f"{metric}_added_positive": F.greatest(added, F.lit(0.0)),
            f"{metric}_added_negative": F.least(added, F.lit(0.0)),
        }
    )


def action_union(passes: DataFrame, carries: DataFrame) -> DataFrame:
    """Completed passes and carries with both points, as one table with ``action_type``."""
    done = passes.where((F.col("type_name") == "Pass") & (F.col("outcome_name") == "Successful"))
    parts = [
        f.select(F.lit(kind).alias("action_type"), *(F.col(c).cast("double").alias(c) if c in ("event_id", "event_time_seconds") else F.col(c) for c in ACTION_COLUMNS))
        for kind, f in (("pass", done), ("carry", carries))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).dropna(subset=["x", "y", "end_x", "end_y"])


def defensive_value(
    events: DataFrame, grid: DataFrame, max_before: float = 15, max_after: float = 12, nx: int = 12, ny: int = 8
) -> DataFrame:
    """The opponents' threat before and after each defensive action.

    Before: the last event of the opponent in the period within ``max_before`` seconds, at its end point if it has one; else the
    action's own place seen from the other end. After: the next event within ``max_after`` seconds; none of the opponent's
    threat is left if the ball is the team's own, or if nothing follows a successful or stopping action. Only matches of exactly two teams count.
    """
    rows = events.dropna(subset=["team_id", "period_value", "event_time_seconds"])
    rows = rows.join(opponent_map(rows), ["match_id", "team_id"])
    order = [F.col("event_time_seconds"), F.col("event_id")]
    back = [c.desc() for c in order]
    seen = ~F.coalesce(F.col("type_name").isin(*IGNORED), F.lit(False))
    at_end = F.col("end_x").isNotNull() & F.col("end_y").isNotNull() & ~F.isnan("end_x") & ~F.isnan("end_y")
    state = F.struct(
        F.col("event_time_seconds").alias("t"), F.col("event_id").alias("id"), F.col("team_id").alias("team"),
        F.when(at_end, F.col("end_x")).otherwise(F.col("x")).alias("sx"), F.when(at_end, F.col("end_y")).otherwise(F.col("y")).alias("sy"),
    )
    period = Window.partitionBy("match_id", "period_value")
    before, ahead = (period.orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (order, back))
    rows = rows.withColumn("_low", F.col("team_id") == F.least("team_id", "opponent_team_id")).withColumns(
        {
            "_low_last": F.last(F.when(seen & F.col("_low"), state), ignorenulls=True).over(before),
            "_high_last": F.last(F.when(seen & ~F.col("_low"), state), ignorenulls=True).over(before),
            "_next": F.last(F.when(seen, state), ignorenulls=True).over(ahead),
        }
    )
    prev = F.when(F.col("_low"), F.col("_high_last")).otherwise(F.col("_low_last"))
    acts = rows.where(F.col("type_name").isin(*DEFENSIVE)).withColumn("_prev", prev)
    t = F.col("event_time_seconds")
    known = F.coalesce(t - F.col("_prev.t") <= max_before, F.lit(False))
    follows = F.coalesce(F.col("_next.t") - t <= max_after, F.lit(False))
    acts = acts.withColumns(
        {
            "before_source": F.when(known, "previous_opponent_event").otherwise("mirrored_defensive_location"),
            "before_zone": zone_of(F.when(known, F.col("_prev.sx")).otherwise(100 - F.col("x")), F.when(known, F.col("_prev.sy")).otherwise(100 - F.col("y")), nx, ny),
            "after_zone": F.when(follows & (F.col("_next.team") == F.col("opponent_team_id")), zone_of(F.col("_next.sx"), F.col("_next.sy"), nx, ny)),
            "after_source": F.when(follows & (F.col("_next.team") == F.col("team_id")), "defending_team_next_event")
            .when(follows, "opponent_next_event")
            .when((F.coalesce(F.col("outcome_name") == "Successful", F.lit(False))) | F.col("type_name").isin(*STOPPERS), "no_next_event_successful_stop")
            .otherwise("no_next_event_no_credit"),
        }
    )
    for side in ("before", "after"):
        cells = grid.select(F.col("zone").alias(f"{side}_zone"), F.col("grid_value").alias(f"_{side}")).dropDuplicates([f"{side}_zone"])
        acts = acts.join(F.broadcast(cells), f"{side}_zone", "left")  # nx * ny rows
    threat = F.coalesce("_before", F.lit(0.0))
    left = F.when(F.col("after_source") == "opponent_next_event", F.coalesce("_after", F.lit(0.0))).when(F.col("after_source") == "no_next_event_no_credit", threat).otherwise(0.0)
    net = F.col("opponent_xpv_before") - F.col("opponent_xpv_after")
    return acts.withColumns({"opponent_xpv_before": threat, "opponent_xpv_after": left}).select(
        "match_id", "event_id", "team_id", "opponent_team_id", "player_id", "period_value", "type_name", "before_source", "after_source",
        "opponent_xpv_before", "opponent_xpv_after", net.alias("net_threat_reduction"),
        F.greatest(net, F.lit(0.0)).alias("opponent_threat_prevented"), F.greatest(-net, F.lit(0.0)).alias("opponent_threat_increased"),
    )


def left_join_aggregates(base: DataFrame, parts: list[tuple[DataFrame, list[Column]]], keys: tuple[str, ...] = ("match_id", "player_id")) -> DataFrame:
    """Left-joins the aggregates of each part by key onto ``base``; rows with a null key are left out and absent numbers are zero."""
    for frame, aggregates in parts:
        made = frame.dropna(subset=list(keys)).groupBy(*keys).agg(*aggregates)
        base = base.join(made, list(keys), "left").fillna(0, [c for c in made.columns if c not in keys])
    return base
