"""One row per player and match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoframe.functions.expressions import non_null_sum
from tempoframe.functions.state import written
from tempoframe.operators import passes as pas
from tempoframe.operators import sequences as seq
from tempoframe.operators import shots as sho

KEYS = ["match_id", "player_id"]


def lineup_faults(lineups: DataFrame, events: DataFrame) -> DataFrame:
    """Lineup rows with ``fault``: why a row that starts or acts without minutes, has no known group or over 130 minutes cannot be used; null for others."""
    acted = events.where(F.col("type_name") != "Card").dropna(subset=KEYS).select(*KEYS, F.lit(True).alias("_acted")).distinct()
    rows = lineups.join(acted, KEYS, "left")
    minutes = F.coalesce(F.col("minutes"), F.lit(0.0))
    absent = (minutes <= 0) & (F.coalesce(F.col("started").cast("int") == 1, F.lit(False)) | F.coalesce("_acted", F.lit(False)))
    fault = (
        F.when(absent, "appearance minutes are missing")
        .when((minutes > 0) & F.coalesce(F.col("position_group") == "Unknown", F.lit(True)), "unknown position")
        .when(minutes > 130, "invalid minutes")
    )
    return rows.withColumns({"fault": fault, "minutes": minutes}).drop("_acted")


def guarded(lineups: DataFrame, events: DataFrame) -> DataFrame:
    """Rows with positive minutes; a row with a fault raises an error when it is read."""
    rows = lineup_faults(lineups, events)
    stop = F.raise_error(F.concat("fault", F.lit(" in match "), F.col("match_id").cast("string"))).cast("double")
    return rows.withColumn("minutes", F.when(F.col("fault").isNotNull(), stop).otherwise(F.col("minutes"))).where("minutes > 0").drop("fault")


def player_match_features(
    lineups: DataFrame, events: DataFrame, passes: DataFrame, shots: DataFrame, keepers: DataFrame, grid: DataFrame
) -> DataFrame:
    """Lineup rows of those who played with totals of passes, shots, carries, values, cards and goalkeeping; what is absent is zero.

    All parts are aggregated by match and player, so their joins share one partitioning. ``xa`` is the xG of the shots that a player's
    passes led to.
    """
    carries = seq.infer_carries(events)
    actions = seq.action_union(events, carries)
    valued = seq.grid_value_added(actions, grid, "xt")
    defence = seq.defensive_value(events, grid)
    made = passes.select("match_id", "team_id", "event_id", "player_id").join(pas.xa_targets(shots), ["match_id", "team_id", "event_id"])
    total = lambda df, **sums: df.dropna(subset=KEYS).groupBy(*KEYS).agg(*(non_null_sum(c).alias(n) for n, c in sums.items()))
    parts = [
        sho.shot_totals(shots),
        pas.pass_totals(passes),
        pas.big_chances_created(passes, shots),
        total(made, xa="xa_target"),
        carries.dropna(subset=KEYS).groupBy(*KEYS).agg(
            F.count("*").alias("carries"),
            *(F.sum(f"is_{c}").alias(n) for c, n in (("progressive_carry", "progressive_carries"), ("final_third_carry", "final_third_carries"), ("carry_into_box", "carries_into_box"))),
        ),
        total(valued, xt_added="xt_added"),
        total(defence, opponent_threat_prevented="opponent_threat_prevented", defensive_net_threat_reduction="net_threat_reduction"),
        sho.discipline_totals(events),
        sho.shot_adjustments(shots),
        sho.goalkeeper_faced(shots, keepers),
    ]
    rows = guarded(lineups, events)
    for part in parts:
        rows = rows.join(part, KEYS, "left").fillna(0, [c for c in part.columns if c not in KEYS])
    return rows


def match_outcomes(pending: DataFrame, lineups: DataFrame, events: DataFrame) -> DataFrame:
    """``status`` and ``error`` of each pending match (``match_id``): 'failed' with the first fault by name of its lineup, or without any events or lineup, else 'processed'."""
    ids = pending.select("match_id").distinct()
    only = lambda df: df.join(ids, "match_id", "left_semi")
    faults = lineup_faults(only(lineups), only(events)).groupBy("match_id").agg(F.min("fault").alias("fault"), F.count_if(F.col("minutes") > 0).alias("played"))
    seen = only(events).groupBy("match_id").agg(F.count("*").alias("events"))
    rows = ids.join(faults, "match_id", "left").join(seen, "match_id", "left")
    error = F.coalesce("fault", F.when(F.coalesce("played", F.lit(0)) == 0, "no player took part"), F.when(F.coalesce("events", F.lit(0)) == 0, "no events"))
    return rows.select("match_id", F.when(error.isNull(), "processed").otherwise("failed").alias("status"), error.alias("error"))


def enrich_increment(
    pending: DataFrame, lineups: DataFrame, events: DataFrame, passes: DataFrame, shots: DataFrame, keepers: DataFrame, grid: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Player-match rows of the pending matches alone (``match_id``), and the outcome of each of them.

    Every input is cut down to them before any work is done. A match with a fault has no rows and is 'failed' with the reason; the others are not touched by it.
    """
    outcomes = written(match_outcomes(pending, lineups, events), "outcomes")
    ids = outcomes.where("status = 'processed'").select("match_id")
    only = lambda df: df.join(ids, "match_id", "left_semi")
    return player_match_features(only(lineups), only(events), only(passes), only(shots), only(keepers), grid), outcomes
