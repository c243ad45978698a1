"""Incremental work: what is new, what can be skipped, and replays of match sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempoframe.functions.state import written
from tempoframe.operators.valuation import replay_steps, rolling_asof_form, valuation_feature_table


def select_new_work(found: DataFrame, done: DataFrame, today: str, most: int) -> DataFrame:
    """Status of each found item (``item_id``, ``item_date``): completed, deferred (future), selected (the newest ``most``) or waiting."""
    rows = found.join(done.select("item_id", F.lit(True).alias("_done")).distinct(), "item_id", "left")
    state = F.when(F.col("_done"), "completed").when(F.col("item_date") > F.lit(today).cast("date"), "deferred").otherwise("open")
    rows = rows.withColumn("_s", state)
    newest = rows.where("_s = 'open'").orderBy(F.col("item_date").desc_nulls_last(), F.col("item_id").desc()).limit(most).select("item_id", F.lit(True).alias("_take"))
    status = F.when(F.col("_s") != "open", F.col("_s")).when(F.col("_take"), "selected").otherwise("waiting")
    return rows.join(newest, "item_id", "left").select(*found.columns, status.alias("status"))


def input_signature_skip(inputs: DataFrame, recorded: DataFrame, config: str, version: str, force: bool = False) -> DataFrame:
    """Adds ``signature`` (digest of inputs, configuration and version) and ``action``: skip where it is the recorded one, else process."""
    signature = F.sha2(F.concat_ws("|", F.coalesce("input_hash", F.lit("∅")), F.lit(config), F.lit(version)).cast("binary"), 256)
    rows = inputs.withColumn("signature", signature).join(recorded.select("match_id", F.col("signature").alias("_was")), "match_id", "left")
    same = F.coalesce(F.col("signature") == F.col("_was"), F.lit(False)) & F.lit(not force)
    return rows.withColumn("action", F.when(same, "skip").otherwise("process")).drop("_was")


def select_last_n(rows: DataFrame, n: int, player_id: int | None = None) -> DataFrame:
    """The last ``n`` matches (of one player, if given), oldest first, with ``sequence`` from 1."""
    chosen = rows if player_id is None else rows.where(F.col("player_id") == player_id)
    last = chosen.select("match_id", "match_date").distinct().orderBy(F.col("match_date").desc(), F.col("match_id").desc()).limit(n)
    return last.withColumn("sequence", F.row_number().over(Window.orderBy("match_date", "match_id")).cast("long"))  # n rows


def replay_sequence(valuations: DataFrame, ratings: DataFrame, n: int, predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each player's last ``n`` matches over again: what a frozen model made of the player the day after each of them.

    ``ratings`` hold what was rated with frozen statistics, as from ``ratings_prepare``; nothing is fitted again. ``predict`` adds ``log_change``, ``log_lower`` and
    ``log_upper`` to rows of ``valuation_feature_table``. Returns one row per match: ``sequence``, ``status`` ('succeeded', or
    'skipped_missing_value' without an earlier value and 'skipped_no_minutes' without minutes since), form and matches known, ``estimate`` with
    limits, and ``estimate_change`` from the estimate before. All steps of all players are one as-of aggregation.
    """
    steps = written(replay_steps(valuations, ratings, n), "steps")
    asked = steps.where("previous_value is not null").drop("match_id", "match_date", "sequence").distinct()
    features = predict(valuation_feature_table(asked, ratings, 1, overlapping=True))
    value = lambda c: F.col("previous_value") * F.exp(c)
    found = features.select(
        "player_id", "valuation_date", value("log_change").alias("estimate"), value("log_lower").alias("estimate_lower"), value("log_upper").alias("estimate_upper"), F.lit(True).alias("_scored")
    )
    form = rolling_asof_form(steps.select("player_id", "valuation_date", "previous_valuation_date").distinct(), ratings).select("player_id", "valuation_date", "asof_form", "matches_last_20")
    status = F.when(F.col("_scored"), "succeeded").when(F.col("previous_value").isNull(), "skipped_missing_value").otherwise("skipped_no_minutes")
    before = Window.partitionBy("player_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    rows = steps.join(form, ["player_id", "valuation_date"], "left").join(found, ["player_id", "valuation_date"], "left")
    return rows.select(
        "player_id", "match_id", "sequence", status.alias("status"), "asof_form", "matches_last_20", "estimate", "estimate_lower", "estimate_upper",
        (F.col("estimate") - F.last("estimate", ignorenulls=True).over(before)).alias("estimate_change"),
    )


def stamp_provenance(rows: DataFrame, provider: str, season: str, version: str, scored_at: str) -> DataFrame:
    """Adds provider, season, version and the given time of scoring, so that results are repeatable."""
    return rows.withColumns({"provider": F.lit(provider), "season": F.lit(season), "model_version": F.lit(version), "scored_at": F.lit(scored_at).cast("timestamp")})


def roster_priority_merge(parts: list[DataFrame], key: str = "player_id", order: str = "club_id") -> DataFrame:
    """One row per key from several lists, the earlier list first and within a list the smallest ``order``."""
    tagged = [p.withColumn("priority", F.lit(k)) for k, p in enumerate(parts)]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t, allowMissingColumns=True)
    n = F.row_number().over(Window.partitionBy(key).orderBy("priority", order))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def clean_player_records(records: DataFrame) -> DataFrame:
    """Trimmed names, whole-number ids and dates as ``dd/MM/yyyy``; what cannot be read is null; the first of repeats stands; rows without id or name carry an issue."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    rows = records.select(
        F.expr("try_cast(trim(id_text) AS bigint)").alias("player_id"), blank(F.col("name_text")).alias("player_name"), F.to_date(F.try_to_timestamp("birth_text", F.lit("dd/MM/yyyy"))).alias("date_of_birth"), "list_index"
    )
    n = F.row_number().over(Window.partitionBy("player_id").orderBy("list_index"))
    issue = F.when(F.col("player_id").isNull(), "missing_id").when(F.col("player_name").isNull(), "missing_name").when(F.col("_n") > 1, "duplicate")
    return rows.withColumn("_n", n).withColumn("issue", issue).drop("_n")


def validate_match_bundle(matches: DataFrame, events: DataFrame, lineups: DataFrame) -> DataFrame:
    """Failed checks of each match: match rows, events, distinct teams, unique events, coordinates, unique lineup rows (a missing lineup is a warning)."""
    e = events.groupBy("match_id").agg(
        F.count("*").alias("events"), F.count_distinct("team_id").alias("teams"), (F.count("event_id") - F.count_distinct("event_id")).alias("repeats"),
        F.count_if(~F.col("x").between(0, 100) | ~F.col("y").between(0, 100)).alias("outside"),
    )
    p = lineups.groupBy("match_id").agg(F.count("*").alias("players"), (F.count("*") - F.count_distinct("player_id")).alias("player_repeats"))
    m = matches.groupBy("match_id").agg(F.count("*").alias("rows"))
    row = m.join(e, "match_id", "left").join(p, "match_id", "left").fillna(0)
    checks = {
        "one_match_row": ("error", F.col("rows") == 1), "events_present": ("error", F.col("events") > 0), "two_teams": ("error", F.col("teams") == 2), "unique_events": ("error", F.col("repeats") == 0),
        "coordinates": ("error", F.col("outside") == 0), "unique_players": ("error", F.col("player_repeats") == 0), "lineup_present": ("warning", F.col("players") > 0),
    }
    items = F.array(*(F.struct(F.lit(k).alias("check"), F.lit(s).alias("severity"), ok.alias("passed")) for k, (s, ok) in checks.items()))
    return row.select("match_id", F.inline(items))
