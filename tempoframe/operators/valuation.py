"""Valuation intervals and the ratings that were known before each valuation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HALF_LIFE = 90.0
MIN_DAYS, MAX_DAYS, MIN_MINUTES = 14, 365, 180
_KEY = ["player_id", "valuation_date"]


def valuation_clean(valuations: DataFrame) -> DataFrame:
    """Positive values that no flag rules out, one per player and date, the largest; a flag counts only if the column exists."""
    ok = F.col("market_value") > 0
    for column, good in (("is_valid_for_model", True), ("is_terminal_record", False), ("is_future_dated", False)):
        if column in valuations.columns:
            ok = ok & (F.coalesce(F.col(column), F.lit(not good)) == good)
    first = F.row_number().over(Window.partitionBy("player_id", "valuation_date").orderBy(F.col("market_value").desc()))
    return valuations.where(ok).withColumn("_n", first).where("_n = 1").drop("_n")


# Fixed column names: counts that are added up over an interval and given per 90 minutes, and rating components that are averaged.
SUMMED = ("goals", "assists", "xg", "xgot", "xa", "big_chances_missed", "big_chance_xg_missed", "own_goals")
COMPONENTS = (
    "threat_component", "creation_component", "progression_component", "retention_component", "attacking_xpv_component", "defensive_component", "finishing_component",
)


def ratings_prepare(ratings: DataFrame) -> DataFrame:
    """Rated rows, one per player and match (the latest date), with every column that intervals need.

    Minutes, starts and counts that are absent or null are zero; components and names that are absent are null.
    """
    zero = {"minutes": "double", "started": "long"} | dict.fromkeys(SUMMED, "double")
    none = {"player_name": "string", "position_group": "string"} | dict.fromkeys(COMPONENTS, "double")
    value = lambda c, t: F.col(c).cast(t) if c in ratings.columns else F.lit(None).cast(t)
    made = {c: F.coalesce(value(c, t), F.lit(0).cast(t)) for c, t in zero.items()} | {c: value(c, t) for c, t in none.items()}
    rows = ratings.where(F.col("rating").isNotNull()).withColumns(made)
    first = F.row_number().over(Window.partitionBy("player_id", "match_id").orderBy(F.col("match_date").desc(), F.col("rating").desc()))
    return rows.withColumn("_n", first).where("_n = 1").drop("_n")


def _ready(ratings: DataFrame) -> DataFrame:
    """``ratings`` as they are if they have all columns of ``ratings_prepare``, else prepared."""
    needed = {"minutes", "started", "player_name", "position_group", *SUMMED, *COMPONENTS}
    return ratings if needed <= set(ratings.columns) else ratings_prepare(ratings)


def valuation_intervals(valuations: DataFrame, ratings: DataFrame) -> DataFrame:
    """Intervals between a rated player's valuations of ``MIN_DAYS`` to ``MAX_DAYS``, with changes of value."""
    kept = valuations.join(ratings.select("player_id").distinct(), "player_id", "left_semi")
    w = Window.partitionBy("player_id").orderBy("valuation_date")
    age = (F.col("age_at_valuation") if "age_at_valuation" in valuations.columns else F.lit(None)).cast("double").alias("age_at_valuation")
    rows = kept.select("player_id", "valuation_date", F.col("market_value").cast("double").alias("market_value"), age).withColumns(
        {
            "previous_valuation_date": F.lag("valuation_date").over(w),
            "previous_value": F.lag("market_value").over(w),
            "_before": F.lag("market_value", 2).over(w),
        }
    )
    rows = rows.withColumns(
        {
            "days_between": F.datediff("valuation_date", "previous_valuation_date").cast("long"),
            "log_value_change": F.log(F.col("market_value") / F.col("previous_value")),
            "pct_value_change": F.col("market_value") / F.col("previous_value") - 1,
            "previous_log_change": F.log(F.col("previous_value") / F.col("_before")),
        }
    )
    return rows.where(F.col("days_between").between(MIN_DAYS, MAX_DAYS)).drop("_before")


def weighted_mean_if(value: str, weight: str, condition: Column | None = None) -> Column:
    """Weighted mean over rows with a value that meet the condition; null if their weights do not add up to more than zero."""
    ok = F.col(value).isNotNull() if condition is None else F.col(value).isNotNull() & condition
    total = F.sum(F.when(ok, F.col(weight)))
    return F.when(total > 0, F.sum(F.when(ok, F.col(value) * F.col(weight))) / total)


def _clipped(minutes: str) -> Column:
    return F.least(F.greatest(F.col(minutes), F.lit(1.0)), F.lit(120.0))


#: Days of a bucket of the as-of join.
BUCKET_DAYS = 90


def interval_asof_join(intervals: DataFrame, ratings: DataFrame, half_life: float = HALF_LIFE, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Each interval with all ratings of the player strictly before the valuation: days before, decayed weight and recency rank.

    Decayed weights take minutes held within 1 and 120. Equal dates rank by match_id, the larger first. The result has a row for each interval
    and earlier match; ``rolling_asof_form`` and ``interval_performance`` do without it.

    Dates are cut into buckets and an interval asks each bucket up to its own, so the join is on player and bucket and a long history lies in as many tasks as it has
    buckets; dates are compared in the last bucket alone. A match has its place in the player's order and an interval the number of matches before it, of whole
    buckets by running counts, so ranks are differences and nothing is sorted by interval.
    """
    bucket = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / bucket_days)
    matches = ratings.select("player_id", "match_id", "match_date", "minutes", "rating", bucket("match_date").alias("_b"))
    within = Window.partitionBy("player_id", "_b").orderBy("match_date", "match_id")
    matches = matches.withColumn("_in", F.row_number().over(within))
    sizes = matches.groupBy("player_id", "_b").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("player_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))  # a row for each player and bucket
    first = sizes.groupBy("player_id").agg(F.min("_b").alias("_first"))
    asked = intervals.select("player_id", "previous_valuation_date", "valuation_date", bucket("valuation_date").alias("_own")).join(first, "player_id").where("_own >= _first")
    asked = asked.select("player_id", "previous_valuation_date", "valuation_date", "_own", F.explode(F.sequence("_first", "_own")).alias("_b"))
    rows = asked.join(sizes, ["player_id", "_b"])
    # How many matches of the cut bucket are before the valuation.
    cut = rows.where("_b = _own").join(matches.select("player_id", "_b", "match_date"), ["player_id", "_b"]).groupBy("player_id", "valuation_date").agg(
        F.count_if(F.col("match_date") < F.col("valuation_date")).alias("_cut")
    )
    whole = F.max(F.when(F.col("_b") < F.col("_own"), F.col("_before") + F.col("_n")))
    known = rows.groupBy("player_id", "valuation_date").agg(F.coalesce(whole, F.lit(0)).alias("_whole")).join(cut, _KEY, "left")
    known = known.select(*_KEY, (F.col("_whole") + F.coalesce("_cut", F.lit(0))).alias("_known"))
    # Intervals learn their number before they meet matches: pairs, the most rows by far, are not moved.
    pairs = rows.join(known, _KEY).join(matches, ["player_id", "_b"]).where((F.col("_b") < F.col("_own")) | (F.col("match_date") < F.col("valuation_date")))
    days = F.datediff("valuation_date", "match_date").cast("long")
    rank = (F.col("_known") - F.col("_before") - F.col("_in") + 1).cast("long")
    return pairs.select(
        *_KEY, "previous_valuation_date", "match_id", "match_date", "minutes", "rating", days.alias("days_before"), rank.alias("recency_rank"),
        (_clipped("minutes") * F.pow(F.lit(2.0), -days / half_life)).alias("decayed_weight"),
    )


def _timeline(intervals: DataFrame, ratings: DataFrame, columns: tuple[str, ...], parts: int) -> DataFrame:
    """Valuations and matches as rows of one table: ``_at`` is the date, ``_kind`` 0 for a valuation, which comes before matches of its day, and 1 for a match.

    Players are dealt into ``parts``, which bound what a task orders; 0 leaves that to adaptive execution.
    """
    dates = intervals.select("player_id", F.col("valuation_date").alias("_at"), F.lit(0).alias("_kind"), "previous_valuation_date")
    both = dates.unionByName(ratings.select("player_id", F.col("match_date").alias("_at"), F.lit(1).alias("_kind"), *columns), allowMissingColumns=True)
    return both.repartition(parts, "player_id") if parts else both


def rolling_asof_form(intervals: DataFrame, ratings: DataFrame, half_life: float = HALF_LIFE, parts: int = 0) -> DataFrame:
    """Form at each valuation from all earlier matches: decayed mean, means of the last 3 and 20 by minutes, and how many there were.

    One row per interval that has an earlier match. Valuations and matches are ordered together, so that running sums do
    the work of a join: a player's rows are read once, however many valuations there are. Decayed weights are relative to
    the player's last date, which cancels.
    """
    rows = _timeline(intervals, ratings, ("match_id", "minutes", "rating"), parts)
    player = Window.partitionBy("player_id")
    order = player.orderBy("_at", "_kind", "match_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    age = F.datediff(F.max("_at").over(player), F.col("_at"))
    weight = F.when(F.col("_kind") == 1, _clipped("minutes") * F.pow(F.lit(2.0), -age / half_life))
    rows = rows.withColumns({"_w": weight, "_k": F.sum("_kind").over(so_far)})
    made = {"_n": F.sum(F.col("_w") * F.col("rating")).over(so_far), "_d": F.sum("_w").over(so_far)}
    for k in (3, 20):
        last = player.orderBy("_k").rangeBetween(-(k - 1), 0)  # a valuation has the number of the match before it
        total = F.sum("minutes").over(last)
        made[f"asof_last_{k}"] = F.when(total > 0, F.sum(F.col("minutes") * F.col("rating")).over(last) / total)
        made[f"matches_last_{k}"] = F.least(F.col("_k"), F.lit(k)).cast("long")
    found = rows.withColumns(made).where("_kind = 0 and _k > 0")
    return found.select("player_id", F.col("_at").alias("valuation_date"), (F.col("_n") / F.col("_d")).alias("asof_form"), "asof_last_3", "asof_last_20", "matches_last_3", "matches_last_20")


def interval_performance(intervals: DataFrame, ratings: DataFrame, half_life: float = HALF_LIFE, parts: int = 0) -> DataFrame:
    """Performance within each interval: matches after the previous valuation and before this one.

    Matches, starts, minutes, latest position and name that are known, means of ratings (by minutes, decayed, of the last 90
    days), their spread, means of components and sums of counts; no row for an interval without a match. A player's
    intervals do not overlap, so each match belongs to the next valuation after it and nothing is joined. ``ratings`` that lack columns of
    ``ratings_prepare`` are prepared first.
    """
    ratings = _ready(ratings)
    columns = ("match_id", "minutes", "rating", "started", "position_group", "player_name", *SUMMED, *COMPONENTS)
    rows = _timeline(intervals, ratings, columns, parts)
    upward = Window.partitionBy("player_id").orderBy(F.col("_at").desc(), F.col("_kind").desc(), F.col("match_id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    following = F.last(F.when(F.col("_kind") == 0, F.struct("_at", "previous_valuation_date")), ignorenulls=True).over(upward)
    rows = rows.withColumn("_next", following).where("_kind = 1").withColumns({"valuation_date": F.col("_next._at"), "_from": F.col("_next.previous_valuation_date")})
    return _performed(rows.where("_at > _from"), half_life)


def overlapping_performance(intervals: DataFrame, ratings: DataFrame, half_life: float = HALF_LIFE) -> DataFrame:
    """``interval_performance`` for intervals of a player that overlap, such as those of several days of judgement: each is joined with its matches."""
    ratings = _ready(ratings)
    keys = intervals.select("player_id", "previous_valuation_date", "valuation_date")
    inside = keys.join(ratings, "player_id").withColumnRenamed("match_date", "_at").where("_at > previous_valuation_date and _at < valuation_date")
    return _performed(inside, half_life)


def _performed(inside: DataFrame, half_life: float) -> DataFrame:
    days = F.datediff("valuation_date", "_at")
    inside = inside.withColumns({"_days": days, "_decayed": _clipped("minutes") * F.pow(F.lit(2.0), -days / half_life)})
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("_at", "match_id")))
    return inside.groupBy(*_KEY).agg(
        F.count_distinct("match_id").alias("matches"),
        F.sum("started").alias("starts"),
        F.sum("minutes").alias("minutes"),
        latest("position_group").alias("latest_position"),
        latest("player_name").alias("player_name"),
        weighted_mean_if("rating", "minutes").alias("mean_rating"),
        weighted_mean_if("rating", "_decayed").alias("decayed_rating"),
        weighted_mean_if("rating", "minutes", F.col("_days") <= 90).alias("last_90_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        *(weighted_mean_if(c, "minutes").alias(f"mean_{c}") for c in COMPONENTS),
        *(F.sum(c).alias(c) for c in SUMMED),
    )


def valuation_feature_table(intervals: DataFrame, ratings: DataFrame, min_minutes: float = MIN_MINUTES, overlapping: bool = False, parts: int = 0) -> DataFrame:
    """Feature rows of intervals with enough minutes: performance, as-of form, transforms and counts per 90 minutes."""
    ratings = _ready(ratings)
    performance = overlapping_performance(intervals, ratings) if overlapping else interval_performance(intervals, ratings, parts=parts)
    rows = intervals.join(performance, _KEY).join(rolling_asof_form(intervals, ratings, parts=parts), _KEY, "left").where(F.col("minutes") >= min_minutes)
    month = F.month("valuation_date") * (2 * 3.141592653589793 / 12)
    per_90 = {f"{c}_per90": F.col(c) * 90.0 / F.col("minutes") for c in SUMMED}
    over = {f"{a}_over_{b}_per90": (F.col(a) - F.col(b)) * 90.0 / F.col("minutes") for a, b in (("goals", "xg"), ("assists", "xa"))}
    return rows.withColumns(
        {
            "log_previous_value": F.log("previous_value"),
            "log_minutes": F.log1p("minutes"),
            "log_matches": F.log1p("matches"),
            "start_share": F.col("starts") / F.col("matches"),
            "age_squared": F.pow("age_at_valuation", F.lit(2.0)),
            "valuation_year": F.year("valuation_date").cast("long"),
            "month_sin": F.sin(month),
            "month_cos": F.cos(month),
            "rating_trend": F.col("last_90_rating") - F.col("mean_rating"),
            **per_90,
            **over,
        }
    )


def current_asof_features(valuations: DataFrame, ratings: DataFrame, as_of: str) -> DataFrame:
    """The same features for a day without a valuation: a pseudo-interval from each player's latest value before it, the age advanced to the day."""
    past = valuations.where(F.col("valuation_date") < F.lit(as_of).cast("date"))
    n = F.row_number().over(Window.partitionBy("player_id").orderBy(F.col("valuation_date").desc()))
    age = (F.col("age_at_valuation") if "age_at_valuation" in valuations.columns else F.lit(None)).cast("double")
    two = past.withColumns({"_n": n, "_age": age}).where("_n <= 2").groupBy("player_id").agg(
        F.max(F.when(F.col("_n") == 1, F.col("valuation_date"))).alias("previous_valuation_date"),
        F.max(F.when(F.col("_n") == 1, F.col("market_value"))).cast("double").alias("previous_value"),
        F.max(F.when(F.col("_n") == 2, F.col("market_value"))).cast("double").alias("_before"),
        F.max(F.when(F.col("_n") == 1, F.col("_age"))).alias("_age"),
    )
    days = F.datediff(F.lit(as_of).cast("date"), "previous_valuation_date").cast("long")
    pseudo = two.withColumns(
        {
            "valuation_date": F.lit(as_of).cast("date"),
            "days_between": days,
            "age_at_valuation": F.col("_age") + days / 365.25,
            "previous_log_change": F.log(F.col("previous_value") / F.col("_before")),
        }
    ).drop("_before", "_age")
    return valuation_feature_table(pseudo.where("days_between > 0"), ratings, 1)


def replay_steps(valuations: DataFrame, ratings: DataFrame, n: int) -> DataFrame:
    """The last ``n`` matches of each player as days of judgement: a pseudo-interval from the last value known to the day after each match.

    One row per match: ``match_id``, ``match_date``, ``sequence`` from 1, ``valuation_date`` (the day after) and, where a value was
    known by then, ``previous_valuation_date``, ``previous_value``, ``previous_log_change`` and ``age_at_valuation`` on the day. Values and days are ordered together, not joined.
    """
    latest = Window.partitionBy("player_id").orderBy(F.col("match_date").desc(), F.col("match_id").desc())
    steps = ratings.select("player_id", "match_id", "match_date").withColumn("_k", F.row_number().over(latest)).where(F.col("_k") <= n).drop("_k")
    by_date = Window.partitionBy("player_id").orderBy("valuation_date")
    age = (F.col("age_at_valuation") if "age_at_valuation" in valuations.columns else F.lit(None)).cast("double")
    value = F.col("market_value").cast("double")
    known = valuations.select("player_id", "valuation_date", F.struct("valuation_date", value.alias("value"), F.lag(value).over(by_date).alias("before"), age.alias("age")).alias("_known"))
    asked = steps.withColumn("valuation_date", F.date_add("match_date", 1))
    both = asked.unionByName(known, allowMissingColumns=True)
    # a value of the day itself is not known yet
    so_far = Window.partitionBy("player_id").orderBy("valuation_date", F.col("_known").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("_last", F.last("_known", ignorenulls=True).over(so_far)).where("match_id is not null")
    days = F.datediff("valuation_date", "_last.valuation_date").cast("long")
    order = Window.partitionBy("player_id").orderBy("match_date", "match_id")
    return rows.select(
        "player_id", "match_id", "match_date", F.row_number().over(order).cast("long").alias("sequence"), "valuation_date",
        F.col("_last.valuation_date").alias("previous_valuation_date"), F.col("_last.value").alias("previous_value"), days.alias("days_between"),
        F.log(F.col("_last.value") / F.col("_last.before")).alias("previous_log_change"), (F.col("_last.age") + days / 365.25).alias("age_at_valuation"),
    )


def dataset_summary(features: DataFrame) -> DataFrame:
    """One row: rows, players, first and last date; of a scored table the mean predicted change and probability of a rise too."""
    scored = {"mean_predicted_change": "predicted_pct_change", "mean_probability_rise": "probability_rise"}
    return features.agg(
        F.count("*").alias("n_rows"), F.count_distinct("player_id").alias("players"), F.min("valuation_date").alias("first_date"), F.max("valuation_date").alias("last_date"),
        *(F.avg(c).alias(name) for name, c in scored.items() if c in features.columns),
    )
