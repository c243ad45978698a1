"""Form states that take rows in and back: decayed sums are inverted, and a bounded tail of matches tells what was last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoframe.functions.state import written
from tempoframe.operators.form import HALF_LIFE, LAST, _counts, _days, form_history

#: Matches of a player that a state keeps, more than are asked of it, so that some can be taken back.
TAIL = 64
_ROW = ("player_id", "match_id", "match_date", "minutes", "rating")
_FORM = ("form_rating_ewm", "rolling_3_match_rating", "rolling_20_match_rating")


def _weighted(rows: DataFrame, end: Column, half_life: float) -> Column:
    return F.when(_counts(rows), F.col("minutes") * F.pow(F.lit(2.0), -_days(end, F.col("match_date")) / half_life)).otherwise(0.0)


def _tailed(rows: DataFrame) -> DataFrame:
    """``tail``, the last ``TAIL`` matches of each player, oldest first."""
    order = Window.partitionBy("player_id").orderBy(F.col("match_date").desc(), F.col("match_id").desc())
    last = rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= TAIL)
    return last.groupBy("player_id").agg(F.sort_array(F.collect_list(F.struct("match_date", "match_id", "minutes", "rating"))).alias("tail"))


def form_ledger(ratings: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """One row per player: decayed sums at its last match, that date, how many matches and rated ones it has, and its last ``TAIL`` matches."""
    rows = ratings.select(*_ROW)
    end = F.max("match_date").over(Window.partitionBy("player_id"))
    rows = rows.withColumn("_w", _weighted(rows, end, half_life))
    sums = rows.groupBy("player_id").agg(
        F.coalesce(F.sum(F.col("_w") * F.col("rating")), F.lit(0.0)).alias("ewm_numerator"), F.sum("_w").alias("ewm_denominator"), F.max("match_date").alias("last_match_date"),
        F.count("*").alias("matches"), F.count_if(_counts(rows)).alias("rated"),
    )
    return sums.join(_tailed(rows), "player_id").withColumn("complete", F.lit(True))


def _rated(tail: str) -> Column:
    return F.filter(tail, lambda r: r["rating"].isNotNull() & (F.coalesce(r["minutes"], F.lit(0.0)) > 0))


def state_of(ledger: DataFrame) -> DataFrame:
    """``form_state`` of a ledger; a row that is not complete raises an error when it is read."""
    recent = _rated("tail")
    checked = F.when(F.col("complete"), F.col("ewm_numerator")).otherwise(F.raise_error(F.lit("a state lacks matches that were taken back")).cast("double"))
    return ledger.select(
        "player_id", checked.alias("ewm_numerator"), "ewm_denominator", "last_match_date", F.slice(recent, F.greatest(F.size(recent) - LAST + 1, F.lit(1)), LAST).alias("recent")
    )


def apply_edits(ledger: DataFrame, edits: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """The ledger after ``edits``, without any history.

    An edit is a rated row with ``op``: 'insert', or 'retract' of a row that is counted, with the values that it was counted with; a correction is both.
    Sums are invertible, whatever the age of the match. A player whose tail has lost so many matches that the last twenty rated
    ones are not known gets ``complete`` false and has to be made anew from its history; one without matches has no row any more.
    """
    edits = edits.select(*_ROW, "op")
    touched = edits.select("player_id").distinct()
    old = ledger.join(touched, "player_id", "left_semi")
    # What is known of a player's matches reaches down to the oldest of the tail, or is everything.
    floor = F.when(F.col("matches") > F.size("tail"), F.struct(F.col("tail")[0]["match_date"].alias("d"), F.col("tail")[0]["match_id"].alias("i")))
    before = old.select("player_id", F.col("ewm_numerator").alias("_top"), F.col("ewm_denominator").alias("_bottom"), F.col("last_match_date").alias("_last"),
                        F.col("matches").alias("_matches"), F.col("rated").alias("_rated"), floor.alias("_floor"), F.col("complete").alias("_complete"))
    rows = edits.join(before, "player_id", "left")
    newest = F.max(F.when(F.col("op") == "insert", F.col("match_date"))).over(Window.partitionBy("player_id"))
    rows = rows.withColumn("_end", F.greatest(newest, "_last"))
    sign = F.when(F.col("op") == "insert", 1).otherwise(-1)
    weight = _weighted(rows, F.col("_end"), half_life) * sign
    moved = rows.groupBy("player_id").agg(
        F.first("_end").alias("_end"), F.coalesce(F.sum(weight * F.col("rating")), F.lit(0.0)).alias("_t"), F.sum(weight).alias("_b"),
        F.sum(sign).alias("_m"), F.sum(F.when(_counts(rows), sign).otherwise(0)).alias("_r"),
    )
    above = F.col("_floor").isNull() | (F.struct(F.col("match_date").alias("d"), F.col("match_id").alias("i")) >= F.col("_floor"))
    came = rows.where(F.col("op") == "insert").where(above).select(*_ROW)
    gone = edits.where(F.col("op") == "retract").select("player_id", "match_id").distinct()
    kept = old.select("player_id", F.inline("tail")).join(gone, ["player_id", "match_id"], "left_anti").select(*_ROW)
    tails = _tailed(kept.unionByName(came))
    joined = moved.join(before, "player_id", "left").join(tails, "player_id", "left")
    tail = F.coalesce("tail", F.array().cast(tails.schema["tail"].dataType))
    joined = joined.withColumn("tail", tail).withColumns({
        "matches": F.coalesce("_matches", F.lit(0)) + F.col("_m"), "rated": F.coalesce("_rated", F.lit(0)) + F.col("_r"), "last_match_date": F.element_at("tail", F.greatest(F.size("tail"), F.lit(1)))["match_date"],
    })
    fade = F.pow(F.lit(2.0), -_days(F.col("_end"), F.coalesce("_last", "_end")) / half_life)
    back = F.pow(F.lit(2.0), _days(F.col("_end"), F.coalesce("last_match_date", "_end")) / half_life)
    total = lambda old_, new: F.when(F.col("rated") > 0, (F.coalesce(F.col(old_) * fade, F.lit(0.0)) + F.col(new)) * back).otherwise(0.0)
    whole = F.size("tail") == F.col("matches")
    enough = F.coalesce("_complete", F.lit(True)) & (whole | (F.size(_rated("tail")) >= LAST))
    after = joined.where("matches > 0").select(
        "player_id", total("_top", "_t").alias("ewm_numerator"), total("_bottom", "_b").alias("ewm_denominator"), "last_match_date", "matches", "rated", "tail", enough.alias("complete")
    )
    return ledger.join(touched, "player_id", "left_anti").unionByName(after.select(*ledger.columns))


def edits_between(stored: DataFrame, current: DataFrame, matches: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The edits that turn the stored rows of ``matches`` (``match_id``) into the current ones, with the columns ``also``; equal rows are left alone."""
    old, new = (df.join(matches.select("match_id").distinct(), "match_id", "left_semi").select(*_ROW, *also) for df in (stored, current))
    return old.exceptAll(new).withColumn("op", F.lit("retract")).unionByName(new.exceptAll(old).withColumn("op", F.lit("insert")))


def player_routes(ledger: DataFrame, edits: DataFrame) -> DataFrame:
    """``route`` of each edited player: 'append' if all its rows come after its last match, else 'recompute'."""
    last = ledger.select("player_id", F.element_at("tail", -1).alias("_l"))
    place = F.struct(F.col("match_date").alias("d"), F.col("match_id").alias("i"))
    late = (F.col("op") == "retract") | F.coalesce(place <= F.struct(F.col("_l.match_date").alias("d"), F.col("_l.match_id").alias("i")), F.lit(False))
    joined = edits.join(last, "player_id", "left")
    return joined.groupBy("player_id").agg(F.when(F.bool_or(late), "recompute").otherwise("append").alias("route"))


def form_continued(ledger: DataFrame, new: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """``form_history`` of new rows that follow their players' states: sums go on from the stored ones, rolling means from the stored last matches."""
    states = ledger.join(new.select("player_id").distinct(), "player_id", "left_semi")
    recent = states.select("player_id", F.inline(_rated("tail"))).withColumn("_new", F.lit(False))
    rows = new.withColumn("_new", F.lit(True)).unionByName(recent, allowMissingColumns=True)
    rolled = form_history(rows, half_life).where("_new").drop("_new", "form_rating_ewm")
    base = states.select("player_id", F.col("ewm_numerator").alias("_t"), F.col("ewm_denominator").alias("_b"), F.col("last_match_date").alias("_last"))
    joined = rolled.join(base, "player_id", "left")
    so_far = Window.partitionBy("player_id").orderBy("match_date", "match_id").rowsBetween(Window.unboundedPreceding, 0)
    end = F.max("match_date").over(Window.partitionBy("player_id"))
    joined = joined.withColumn("_w", _weighted(joined, end, half_life)).withColumn("_f", F.pow(F.lit(2.0), -_days(end, F.coalesce("_last", end)) / half_life))
    top = F.coalesce(F.sum(F.col("_w") * F.col("rating")).over(so_far), F.lit(0.0)) + F.coalesce(F.col("_t") * F.col("_f"), F.lit(0.0))
    bottom = F.sum("_w").over(so_far) + F.coalesce(F.col("_b") * F.col("_f"), F.lit(0.0))
    made = joined.withColumns({"_top": top, "_bottom": bottom})
    return made.withColumn("form_rating_ewm", F.when(F.col("_bottom") > 0, F.col("_top") / F.col("_bottom"))).select(*new.columns, *_FORM)


def advanced(history: DataFrame, ledger: DataFrame, edits: DataFrame, half_life: float = HALF_LIFE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History with form, ledger and routes after edits: each player takes its own route.

    Players without edits keep their rows; rows that follow a state go on from it; players with late or corrected rows are computed again from their
    own rows alone. States change by their edits, and only those that these leave incomplete are made anew. Other columns of the history come with the edits, or are null.
    """
    edits = written(edits, "edits")
    routes = written(player_routes(ledger, edits), "routes")
    base = [c for c in history.columns if c not in _FORM]
    again = routes.where("route = 'recompute'").select("player_id")
    new = edits.where("op = 'insert'").drop("op")
    given = [c for c in base if c in new.columns]
    appended = form_continued(ledger, new.join(again, "player_id", "left_anti"), half_life)
    gone = edits.where("op = 'retract'").select("player_id", "match_id")
    old = history.join(again, "player_id", "left_semi").join(gone, ["player_id", "match_id"], "left_anti").select(*base)
    late = new.join(again, "player_id", "left_semi").select(*given)
    again_rows = form_history(old.unionByName(late, allowMissingColumns=True), half_life).select(*history.columns)
    after = history.join(again, "player_id", "left_anti").unionByName(appended.select(*given, *_FORM), allowMissingColumns=True).unionByName(again_rows)
    after = written(after.select(*history.columns), "history")
    states = written(apply_edits(ledger, edits, half_life), "ledger")
    broken = states.where("not complete").select("player_id")
    anew = form_ledger(after.join(broken, "player_id", "left_semi"), half_life).select(*states.columns)
    return after, states.where("complete").unionByName(anew), routes
