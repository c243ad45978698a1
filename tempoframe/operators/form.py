"""Decayed form over dated, weighted ratings: histories, states and their continuation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HALF_LIFE = 90.0
LAST = 20


def _days(a: Column, b: Column) -> Column:
    return (F.unix_seconds(a.cast("timestamp")) - F.unix_seconds(b.cast("timestamp"))) / 86400.0


def _counts(rows: DataFrame) -> Column:
    return F.col("rating").isNotNull() & (F.coalesce(F.col("minutes"), F.lit(0.0)) > 0)


def form_history(ratings: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """Adds form after each match of a player: ``form_rating_ewm``, ``rolling_3_match_rating``, ``rolling_20_match_rating``.

    ``ratings`` has ``player_id, match_id, match_date, minutes, rating``; order is by date and match. Form is the mean of ratings
    weighted by minutes and halved every ``half_life`` days; the weights are taken relative to the player's last match, which cancels. Rows without a
    rating or minutes carry the values forward. Rolling means count rated matches only.
    """
    order = [F.col("match_date"), F.col("match_id")]
    player = Window.partitionBy("player_id")
    so_far = player.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    used = _counts(ratings)
    weight = F.when(used, F.col("minutes") * F.pow(F.lit(2.0), -_days(F.max("match_date").over(player), F.col("match_date")) / half_life))
    rows = ratings.withColumns({"_w": weight, "_m": F.when(used, F.col("minutes")), "_k": F.count(F.when(used, 1)).over(so_far)})
    rows = rows.withColumns({"_n": F.sum(F.col("_w") * F.col("rating")).over(so_far), "_d": F.sum("_w").over(so_far)})
    sums = {}
    for k in (3, LAST):
        # Unrated rows share the count of the rated row before them, so a range over the count spans exactly k rated rows.
        last = player.orderBy("_k").rangeBetween(-(k - 1), 0)
        sums[f"rolling_{k}_match_rating"] = F.when(F.col("_k") > 0, F.sum(F.when(used, F.col("minutes") * F.col("rating"))).over(last) / F.sum("_m").over(last))
    return rows.withColumns({"form_rating_ewm": F.when(F.col("_d") > 0, F.col("_n") / F.col("_d")), **sums}).drop("_w", "_m", "_k", "_n", "_d")


def form_state(ratings: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """One row per player after all its matches: decayed numerator and denominator at its last match, that date, and the last 20 rated matches, oldest first.

    The last twenty are found by rank before they are gathered, so a player's row never holds more.
    """
    used = _counts(ratings)
    order = [F.col("match_date").desc(), F.col("match_id").desc()]
    last = F.max("match_date").over(Window.partitionBy("player_id"))
    weight = F.when(used, F.col("minutes") * F.pow(F.lit(2.0), -_days(last, F.col("match_date")) / half_life)).otherwise(0.0)
    rows = ratings.withColumns({"_w": weight, "_last": last, "_r": F.row_number().over(Window.partitionBy("player_id", used.alias("u")).orderBy(*order))})
    item = F.when(used & (F.col("_r") <= LAST), F.struct("match_date", "match_id", "minutes", "rating"))
    return rows.groupBy("player_id").agg(
        F.coalesce(F.sum(F.col("_w") * F.col("rating")), F.lit(0.0)).alias("ewm_numerator"),
        F.sum("_w").alias("ewm_denominator"),
        F.max("match_date").alias("last_match_date"),
        F.sort_array(F.collect_list(item)).alias("recent"),
    )


def form_append(state: DataFrame, new: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """The state after new rows, without the old ones: the stored sums decay to the new last match, and stored and new matches share the last 20.

    A new row before the player's stored last match raises an error when it is read.
    """
    fresh = form_state(new, half_life)
    first = new.groupBy("player_id").agg(F.min("match_date").alias("_first"))
    cols = ("ewm_numerator", "ewm_denominator", "last_match_date", "recent")
    joined = state.select("player_id", *(F.col(c).alias(f"_{c}") for c in cols)).join(fresh, "player_id", "full").join(first, "player_id", "left")
    late = F.col("_first") < F.col("_last_match_date")
    end = F.greatest("last_match_date", "_last_match_date")
    decay = F.pow(F.lit(2.0), -_days(end, F.coalesce("_last_match_date", end)) / half_life)
    both = lambda c: F.coalesce(F.col(f"_{c}") * decay, F.lit(0.0)) + F.coalesce(F.col(c), F.lit(0.0))
    recent = F.sort_array(F.concat(F.coalesce("_recent", F.array()), F.coalesce("recent", F.array())))
    checked = F.when(F.coalesce(late, F.lit(False)), F.raise_error(F.lit("a new match is before the stored last match")).cast("date")).otherwise(end.cast("date"))
    return joined.select(
        "player_id", both("ewm_numerator").alias("ewm_numerator"), both("ewm_denominator").alias("ewm_denominator"), checked.alias("last_match_date"),
        F.slice(recent, F.greatest(F.size(recent) - LAST + 1, F.lit(1)), LAST).alias("recent"),
    )


def changed_partitions(current: DataFrame, processed: DataFrame, key: str = "match_id", digest: str = "input_hash") -> DataFrame:
    """Keys that are new or whose digest differs from the processed one, with ``status``."""
    known = processed.select(key, F.col(digest).alias("_was"), F.lit(True).alias("_known"))
    joined = current.join(known, key, "left")
    status = F.when(F.col("_known").isNull(), "new").when(~F.col(digest).eqNullSafe(F.col("_was")), "changed")
    return joined.withColumn("status", status).where("status is not null").select(key, digest, "status")
