"""Match ratings: priors, per-90 features, standardisation, components, composites and final ratings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoframe.functions.expressions import clip, finite
from tempoframe.functions.state import written
from tempoframe.operators.appearances import GROUPS

OUTFIELD = tuple(GROUPS)
GROUP = ["season", "position_group"]
# Counts that become log per-90 features, and signed values that become per-90 features.
LOG_COUNTS = ("xg", "xgot", "shots", "xa", "key_passes", "big_chances_created", "progressive_passes", "progressive_carries", "final_third_carries")
SIGNED = ("xpv_added", "opponent_threat_prevented", "defensive_net_threat_reduction")
KEEPER_FEATURES = ("goals_prevented", "save_percentage")
FEATURES = (
    *(f"log_{c}_90" for c in LOG_COUNTS), *(f"{c}_90" for c in SIGNED),
    "pass_completion_above_expected", "finishing_above_expected", "shot_placement_above_expected",
)
# Weights of features in components and of components by position.
COMPONENTS = {
    "threat_component": {"log_xg_90": 0.40, "log_xgot_90": 0.35, "log_shots_90": 0.25},
    "creation_component": {"log_xa_90": 0.55, "log_key_passes_90": 0.25, "log_big_chances_created_90": 0.20},
    "progression_component": {"log_progressive_passes_90": 0.45, "log_progressive_carries_90": 0.35, "log_final_third_carries_90": 0.20},
    "retention_component": {"pass_completion_above_expected": 1.0},
    "attacking_xpv_component": {"xpv_added_90": 1.0},
    "defensive_component": {"opponent_threat_prevented_90": 0.60, "defensive_net_threat_reduction_90": 0.40},
    "finishing_component": {"finishing_above_expected": 0.60, "shot_placement_above_expected": 0.40},
}
WEIGHTS = {
    "Forward": (0.28, 0.15, 0.10, 0.05, 0.12, 0.03, 0.27),
    "Midfielder": (0.08, 0.25, 0.22, 0.12, 0.13, 0.08, 0.12),
    "Defender": (0.03, 0.08, 0.17, 0.15, 0.10, 0.40, 0.07),
}
FEATURE_CLIP, COMPOSITE_CLIP, SPAN = 4.5, 5.0, 3.30


def pass_completion_prior(features: DataFrame) -> DataFrame:
    """Prior share of completed passes and its strength for each season and outfield position.

    Rows of five passes or more are used, all rows of a group that has none. Null counts are zero.
    """
    tried, done = finite(F.col("passes")), finite(F.col("completed_passes"))
    rows = features.where(F.col("position_group").isin(*OUTFIELD)).select(*GROUP, tried.alias("t"), done.alias("d"))
    rows = rows.withColumn("some", F.max("t").over(Window.partitionBy(*GROUP)) >= 5).where(~F.col("some") | (F.col("t") >= 5))
    rate = F.when(F.col("t") > 0, F.least(F.greatest(F.col("d") / F.col("t"), F.lit(0.0)), F.lit(1.0)))
    sums = rows.groupBy(*GROUP).agg(
        F.sum("t").alias("attempted_passes"), F.sum("d").alias("done"), F.count("*").alias("match_rows"),
        F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("observed_variance"), F.coalesce(F.avg(F.when(F.col("t") > 0, 1 / F.col("t"))), F.lit(0.0)).alias("inverse"),
    )
    completed = F.least("done", "attempted_passes")
    sums = sums.withColumn("completed_passes", completed)
    p0 = F.when(F.col("attempted_passes") > 0, F.col("completed_passes") / F.col("attempted_passes")).otherwise(0.75)
    sums = sums.withColumn("pass_completion_prior", p0)
    p = F.col("pass_completion_prior")
    sums = sums.withColumn("sampling_variance", p * (1 - p) * F.col("inverse"))
    sums = sums.withColumn("between_match_variance", clip(F.col("observed_variance") - F.col("sampling_variance"), 0.0025, 0.05))
    strength = clip(p * (1 - p) / F.col("between_match_variance") - 1, 5, 60)
    return sums.withColumn("prior_strength", strength).drop("done", "inverse")


def per90_log_features(features: DataFrame, priors: DataFrame) -> DataFrame:
    """Adds per-90, log, smoothed and over-expected features; non-finite inputs are zero; groups without a prior have 0.75 and strength 20."""
    n = lambda c: finite(F.col(c))
    short = F.greatest(F.least(n("minutes"), F.lit(90.0)), F.lit(30.0))
    prior = priors.select(*GROUP, "pass_completion_prior", F.col("prior_strength").alias("pass_prior_strength"))
    rows = features.join(F.broadcast(prior), GROUP, "left")  # a row for each season and position
    rows = rows.fillna({"pass_completion_prior": 0.75, "pass_prior_strength": 20.0})
    made = {f"{c}_90": 90 * F.greatest(n(c), F.lit(0.0)) / short for c in LOG_COUNTS}
    made |= {f"log_{c}_90": F.log1p(90 * F.greatest(n(c), F.lit(0.0)) / short) for c in LOG_COUNTS}
    made |= {f"{c}_90": 90 * n(c) / short for c in SIGNED}
    tried = F.greatest(n("passes"), F.lit(0.0))
    done = F.least(F.greatest(n("completed_passes"), F.lit(0.0)), tried)
    p, s = F.col("pass_completion_prior"), F.col("pass_prior_strength")
    sot, held = F.greatest(n("shots_on_target_faced"), F.lit(0.0)), F.greatest(n("goals_conceded_xgot_sample"), F.lit(0.0))
    saves = F.greatest(sot - held, F.lit(0.0))
    made |= {
        "smoothed_pass_completion": (done + s * p) / (tried + s),
        "pass_completion_above_expected": (done + s * p) / (tried + s) - p,
        "finishing_above_expected": clip(n("goals") - n("xg"), -2, 3),
        "shot_placement_above_expected": clip(n("xgot") - n("xg"), -2, 3),
        "saves": saves,
        "save_percentage": F.when(sot > 0, saves / sot).otherwise(0.0),
        "goals_prevented": n("xgot_faced") - held,
    }
    return rows.withColumns(made)


def _long(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), finite(F.col(f)).alias("value")) for f in features))
    return rows.select(*GROUP, F.inline(pairs))


def zscore_fit(features: DataFrame, outfield: tuple[str, ...] = FEATURES) -> DataFrame:
    """Mean, sample deviation and size by season, position and feature; a deviation of 1e-9 or less counts as one.

    Goalkeepers have their own two features, over rows with shots faced if the group has any.
    """
    field = _long(features.where(F.col("position_group").isin(*OUTFIELD)), outfield)
    keepers = features.where(F.col("position_group") == "Goalkeeper")
    keepers = keepers.withColumn("_some", F.max(finite(F.col("shots_on_target_faced"))).over(Window.partitionBy(*GROUP)) > 0)
    keepers = keepers.where(~F.col("_some") | (finite(F.col("shots_on_target_faced")) > 0))
    stats = field.unionByName(_long(keepers, KEEPER_FEATURES)).groupBy(*GROUP, "feature").agg(
        F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"), F.count("*").alias("sample_size")
    )
    return stats.withColumn("std", F.when(F.col("std") <= 1e-9, 1.0).otherwise(F.col("std")))


def zscore_apply(features: DataFrame, stats: DataFrame, names: tuple[str, ...] = FEATURES, bound: float = FEATURE_CLIP) -> DataFrame:
    """Adds ``z_<feature>``, clipped; a row whose group lacks a statistic that it needs raises an error when it is read."""
    wide = stats.groupBy(*GROUP).agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std")))).alias("_stats"))
    rows = features.join(F.broadcast(wide), GROUP, "left")  # a row for each season and position
    keeper, field = F.col("position_group") == "Goalkeeper", F.col("position_group").isin(*OUTFIELD)
    made = {}
    for f in names:
        stat = F.col("_stats")[f]
        needed = keeper if f in KEEPER_FEATURES else field
        known = F.when(stat.isNull(), F.raise_error(F.lit(f"no statistic of {f} for a group")).cast("double")).otherwise(clip((finite(F.col(f)) - stat["mean"]) / stat["std"], -bound, bound))
        made[f"z_{f}"] = F.when(needed, known)
    return rows.withColumns(made).drop("_stats")


def _weighted(terms: dict[str, float]) -> Column:
    return reduce(lambda a, b: a + b, (F.col(c) * w for c, w in terms.items()))


def rating_components(scored: DataFrame) -> DataFrame:
    """Adds the seven components from standardised features; null for goalkeepers and unknown positions."""
    return scored.withColumns({name: _weighted({f"z_{f}": w for f, w in terms.items()}) for name, terms in COMPONENTS.items()})


def position_composite(scored: DataFrame) -> DataFrame:
    """Adds the position-weighted composite, the reliability of the minutes played, and their product."""
    raw = F.lit(None).cast("double")
    for group, weights in WEIGHTS.items():
        raw = F.when(F.col("position_group") == group, _weighted(dict(zip(COMPONENTS, weights, strict=True)))).otherwise(raw)
    reliability = 0.25 + 0.75 * F.sqrt(F.greatest(F.least(finite(F.col("minutes")) / 90, F.lit(1.0)), F.lit(0.0)))
    made = scored.withColumns({"raw_position_composite": raw, "minutes_reliability": reliability})
    return made.withColumn("reliability_adjusted_composite", F.col("raw_position_composite") * F.col("minutes_reliability"))


def composite_restandardize(composed: DataFrame) -> DataFrame:
    """Statistics of the composite by season and position, in the shape of ``zscore_fit``."""
    return zscore_fit(composed.where(F.col("position_group").isin(*OUTFIELD) & (finite(F.col("minutes")) > 0)).withColumn("shots_on_target_faced", F.lit(0.0)), ("reliability_adjusted_composite",))


def outfield_rating(z: Column) -> Column:
    """Six plus a bounded curve of the standardised composite."""
    return 6 + SPAN * F.tanh(clip(z, -COMPOSITE_CLIP, COMPOSITE_CLIP) / SPAN)


def goalkeeper_rating() -> Column:
    """Six plus standardised shot stopping, as far as shots faced can tell, plus a bonus for a busy clean sheet."""
    sot = finite(F.col("shots_on_target_faced"))
    trust = F.sqrt(F.greatest(F.least(sot / 5, F.lit(1.0)), F.lit(0.0)))
    clean = F.when((finite(F.col("goals_conceded")) == 0) & (sot >= 3), 0.15).otherwise(0.0)
    return 6 + trust * (0.80 * F.col("z_goals_prevented") + 0.20 * F.col("z_save_percentage")) + clean


def rating_adjustments(rated: DataFrame, base: str = "base_rating") -> DataFrame:
    """Adds bonus, penalties and ``post_match_rating`` in [1, 10]; null without a base rating."""
    n = lambda c: finite(F.col(c))
    over = clip(n("assists") - n("xa"), 0, 2)
    bonus = clip(0.10 * F.least(n("goals"), F.lit(3.0)) + 0.05 * F.least(n("assists"), F.lit(2.0)) + 0.05 * over, 0, 0.50)
    cards = 0.15 * n("yellow_cards") + 1.25 * n("red_cards")
    missed, own = F.least(0.10 * n("big_chances_missed"), F.lit(0.30)), F.least(0.70 * n("own_goals"), F.lit(1.40))
    made = rated.withColumns({"decisive_action_bonus": bonus, "card_penalty": cards, "big_chance_miss_penalty": missed, "own_goal_penalty": own})
    total = F.col(base) + F.col("decisive_action_bonus") - F.col("card_penalty") - F.col("big_chance_miss_penalty") - F.col("own_goal_penalty")
    return made.withColumn("post_match_rating", clip(total, 1, 10))


def rate_matches(features: DataFrame, priors: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Ratings of player-match rows; given priors and statistics are frozen, otherwise they are fitted on the rows.

    What is fitted and then applied to the same rows is written once to the shared folder in between.
    """
    return fitted_ratings(features, priors, stats)[0]


def fitted_ratings(features: DataFrame, priors: DataFrame | None = None, stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with the priors and the statistics (of features and of the composite) that they were made with, to be frozen."""
    priors = pass_completion_prior(features) if priors is None else priors
    made = written(per90_log_features(features, priors), "per90")
    fitted = zscore_fit(made) if stats is None else stats
    scored = zscore_apply(made, fitted, (*FEATURES, *KEEPER_FEATURES))
    composed = written(position_composite(rating_components(scored)), "composed")
    again = composite_restandardize(composed) if stats is None else stats
    final = zscore_apply(composed, again, ("reliability_adjusted_composite",), COMPOSITE_CLIP)
    z = F.col("z_reliability_adjusted_composite")
    base = F.when(finite(F.col("minutes")) > 0, F.when(F.col("position_group") == "Goalkeeper", goalkeeper_rating()).otherwise(outfield_rating(z)))
    rated = rating_adjustments(final.withColumn("standardized_composite", z).withColumn("base_rating", base))
    return rated, priors, fitted if stats is not None else fitted.unionByName(again)


def primary_position(features: DataFrame, keys: tuple[str, ...] = ("season", "player_id")) -> DataFrame:
    """Most frequent group in started matches for each of ``keys``, the first by name among equals, with its starts."""
    starts = features.where((F.col("started").cast("int") == 1) & F.col("position_group").isNotNull() & (F.col("position_group") != "Unknown"))
    counted = starts.groupBy(*keys, "position_group").agg(F.count("*").alias("starts"))
    best = F.min_by(F.struct("position_group", "starts"), F.struct(-F.col("starts"), "position_group"))
    return counted.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.position_group").alias("primary_position"), F.col("b.starts").alias("position_starts"))


def apply_primary_position(features: DataFrame) -> DataFrame:
    """Rows that did not start take the season's primary position, else the career's; null if there is neither, whatever their own."""
    season = primary_position(features).select("season", "player_id", F.col("primary_position").alias("_season"))
    career = primary_position(features, ("player_id",)).select("player_id", F.col("primary_position").alias("_career"))
    joined = features.join(season, ["season", "player_id"], "left").join(career, "player_id", "left")
    own = F.when(F.coalesce(F.col("started").cast("int"), F.lit(0)) == 1, F.col("position_group")).otherwise(F.coalesce("_season", "_career"))
    return joined.withColumn("position_group", own).select(*features.columns)


def rating_validate(ratings: DataFrame, keys: tuple[str, ...] = ("season", "match_id", "player_id"), rating: str = "post_match_rating") -> DataFrame:
    """One row of ``n_rows``, ``duplicate_keys``, ``out_of_range`` and ``valid``; a missing column is an error."""
    if missing := sorted({*keys, rating} - set(ratings.columns)):
        raise ValueError(f"ratings lack columns: {missing}")
    by_key = ratings.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(~F.col(rating).between(1, 10)).alias("bad"))
    total = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.coalesce(F.sum("bad"), F.lit(0)).alias("out_of_range"))
    return total.withColumn("valid", (F.col("duplicate_keys") == 0) & (F.col("out_of_range") == 0))
