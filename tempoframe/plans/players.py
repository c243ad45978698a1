"""Queries over appearances, player-match rows and ratings, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.functions.state import shared_path, written
from tempoframe.operators import appearances as app
from tempoframe.operators import chain
from tempoframe.operators import player_match as pm
from tempoframe.operators import ratings as rat
from tempoframe.plans import features as fea
from tempoframe.plans.events import ACTIONS, CARRIES, DEFENCE, VALUED
from tempoframe.plans.fixtures import ctes, projected


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(spark, sf_dir, "match_events").withColumn("minute", F.col("expanded_minute"))


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app.appearance_minutes(projected(spark, sf_dir, "player_matches"), _events(spark, sf_dir), projected(spark, sf_dir, "substitutions"))


def appearance_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes of all lineup rows."""
    return _minutes(spark, sf_dir).select("match_id", "player_id", "minutes", "minutes_source")


def position_group_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all lineup rows, by each variant."""
    rows = projected(spark, sf_dir, "player_matches")
    return rows.select("match_id", "player_id", *(app.position_group(F.col("position_code"), v).alias(v) for v in ("strict", "lenient", "synonym")))


def propagate_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all lineup rows after substitutions handed them on."""
    rows = projected(spark, sf_dir, "player_matches").withColumn("position_group", app.position_group(F.col("position_code"), "lenient"))
    return app.propagate_positions(rows, projected(spark, sf_dir, "substitutions")).select("match_id", "player_id", "position_group")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    lineups = _minutes(spark, sf_dir).withColumn("position_group", F.coalesce(app.position_group(F.col("position_code"), "lenient"), F.lit("Midfielder")))
    made = pm.player_match_features(lineups, events, fea._passes(spark, sf_dir), fea._shots(spark, sf_dir), fea._keepers(spark, sf_dir), projected(spark, sf_dir, "value_grid"))
    season = F.when(F.col("match_id") % 2 == 0, "2024-2025").otherwise("2025-2026")
    return made.withColumns({"season": season, "xpv_added": F.col("xt_added") / 2})


TOTALS = (
    "shots", "goals", "xg", "xgot", "passes", "completed_passes", "key_passes", "progressive_passes", "assists", "big_chances_created", "xa", "carries",
    "progressive_carries", "final_third_carries", "carries_into_box", "xt_added", "opponent_threat_prevented", "defensive_net_threat_reduction", "yellow_cards",
    "red_cards", "big_chances_missed", "big_chance_xg_missed", "own_goals", "shots_on_target_faced", "goals_conceded", "xgot_faced", "goals_conceded_xgot_sample",
)
_DOUBLE_TOTALS = ["xg", "xgot", "xa", "xt_added", "opponent_threat_prevented", "defensive_net_threat_reduction", "big_chance_xg_missed", "xgot_faced"]


def player_match_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All player-match rows."""
    return rounded(_rows(spark, sf_dir).select("season", "match_id", "player_id", "team_id", "position_group", "minutes", *TOTALS))


def enrich_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player-match rows of the pending third of the matches with the outcome of each; some lineups have a row of 131 minutes, and their matches fail alone."""
    events = _events(spark, sf_dir)
    lineups = _minutes(spark, sf_dir).withColumn("position_group", F.coalesce(app.position_group(F.col("position_code"), "lenient"), F.lit("Midfielder")))
    lineups = lineups.withColumn("minutes", F.when(F.col("match_id") % 9 == 0, F.lit(131.0)).otherwise(F.col("minutes")))
    pending = events.select("match_id").where("match_id % 3 = 0")
    made, outcomes = pm.enrich_increment(pending, lineups, events, fea._passes(spark, sf_dir), fea._shots(spark, sf_dir), fea._keepers(spark, sf_dir), projected(spark, sf_dir, "value_grid"))
    rows = outcomes.join(made.select("match_id", "player_id", "minutes", *TOTALS), "match_id", "left")
    return rounded(rows.select("match_id", "status", "error", "player_id", "minutes", *TOTALS))


def pass_completion_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass priors."""
    return rounded(rat.pass_completion_prior(_rows(spark, sf_dir)))


_PER90 = (*(f"{c}_90" for c in rat.LOG_COUNTS), *rat.FEATURES, "smoothed_pass_completion", "saves", "save_percentage", "goals_prevented")


def _per90(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(_rows(spark, sf_dir), "player-rows")  # read by every fit below
    return written(rat.per90_log_features(rows, rat.pass_completion_prior(rows)), "per90")


def per90_log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating features of all rows."""
    return rounded(_per90(spark, sf_dir).select("match_id", "player_id", *_PER90))


def zscore_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all groups."""
    return rounded(rat.zscore_fit(_per90(spark, sf_dir)))


_ALL = (*rat.FEATURES, *rat.KEEPER_FEATURES)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _per90(spark, sf_dir)
    return rat.zscore_apply(made, rat.zscore_fit(made), _ALL)


def zscore_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised features of all rows."""
    return rounded(_scored(spark, sf_dir).select("match_id", "player_id", *(f"z_{f}" for f in _ALL)))


def rating_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all rows."""
    return rounded(rat.rating_components(_scored(spark, sf_dir)).select("match_id", "player_id", *rat.COMPONENTS))


def _composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rat.position_composite(rat.rating_components(_scored(spark, sf_dir)))


def position_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composites of all rows."""
    return rounded(_composed(spark, sf_dir).select("match_id", "player_id", "raw_position_composite", "minutes_reliability", "reliability_adjusted_composite"))


def composite_restandardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the composites."""
    return rounded(rat.composite_restandardize(_composed(spark, sf_dir)))


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rat.rate_matches(written(_rows(spark, sf_dir), "player-rows"))


def outfield_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base ratings of outfield players."""
    return rounded(_rated(spark, sf_dir).where("position_group <> 'Goalkeeper'").select("match_id", "player_id", "standardized_composite", "base_rating"))


def goalkeeper_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base ratings of goalkeepers."""
    return rounded(_rated(spark, sf_dir).where("position_group = 'Goalkeeper'").select("match_id", "player_id", "base_rating"))


def rating_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final ratings of all rows."""
    return rounded(_rated(spark, sf_dir).select("match_id", "player_id", "decisive_action_bonus", "card_penalty", "big_chance_miss_penalty", "own_goal_penalty", "post_match_rating"))


def materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table of all players."""
    rows = written(_rows(spark, sf_dir), "player-rows").withColumn("match_date", F.date_add(F.lit("2024-08-01"), F.col("match_id").cast("int")))
    path = shared_path(spark, "materialized")
    chain.materialize(rows, path)
    return rounded(chain.materialize(rows, path))  # a second run reads what the first one kept


def primary_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary positions by season and player."""
    return rat.primary_position(_lineups(spark, sf_dir))


def _lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = projected(spark, sf_dir, "player_matches")
    season = F.when(F.col("match_id") % 2 == 0, "2024-2025").otherwise("2025-2026")
    return rows.select("match_id", "player_id", "started", season.alias("season"), app.position_group(F.col("position_code"), "strict").alias("position_group"))


def apply_primary_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineup rows with primary positions for those who did not start."""
    return rat.apply_primary_position(_lineups(spark, sf_dir)).select("match_id", "player_id", "position_group")


def rating_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of all ratings of the order fixture."""
    rows = projected(spark, sf_dir, "player_ratings").withColumnRenamed("rating", "post_match_rating").withColumn("season", F.year("match_date"))
    return rat.rating_validate(rows)


QUERIES = (
    appearance_minutes, position_group_map, propagate_positions, player_match_features, enrich_increment, pass_completion_prior, per90_log_features, zscore_fit, zscore_apply,
    rating_components, position_composite, composite_restandardize, outfield_rating, goalkeeper_rating, rating_adjustments, materialize, primary_position,
    apply_primary_position, rating_validate,
)

MINUTES = """
turns AS (
  SELECT match_id, player_id, min(event_minute) FILTER (WHERE role = 'on') AS on_minute, min(event_minute) FILTER (WHERE role = 'off') AS off_minute
  FROM (SELECT match_id, player_id, event_minute, 'on' AS role FROM substitutions UNION ALL
        SELECT match_id, related_player_id, event_minute, 'off' FROM substitutions UNION ALL
        SELECT match_id, player_id, expanded_minute, 'off' FROM match_events WHERE card_type IN ('Red', 'Second Yellow')) t GROUP BY match_id, player_id),
acted AS (SELECT match_id, player_id, min(expanded_minute) AS first_minute FROM match_events GROUP BY match_id, player_id),
ends AS (SELECT match_id, CASE WHEN max(expanded_minute) > 105 OR bool_or(period_value IN (3, 4)) THEN 120 ELSE 90 END AS match_end FROM match_events GROUP BY match_id),
minutes AS (
  SELECT p.match_id, p.player_id, p.team_id, p.position_code, p.started,
         CASE WHEN p.minutes > 0 THEN p.minutes
              WHEN started = 1 OR on_minute IS NOT NULL OR off_minute IS NOT NULL OR first_minute IS NOT NULL
              THEN least(greatest(coalesce(off_minute, match_end) - CASE WHEN started = 1 THEN 0 ELSE coalesce(on_minute, first_minute, match_end) END, 1), 130)
              ELSE 0 END::DOUBLE AS minutes,
         CASE WHEN p.minutes > 0 THEN 'provider' WHEN started = 1 OR on_minute IS NOT NULL OR off_minute IS NOT NULL OR first_minute IS NOT NULL
              THEN 'derived_lineup_events' ELSE 'not_played' END AS minutes_source
  FROM player_matches p LEFT JOIN turns t ON t.match_id = p.match_id AND t.player_id = p.player_id
  LEFT JOIN acted a ON a.match_id = p.match_id AND a.player_id = p.player_id LEFT JOIN ends e ON e.match_id = p.match_id)"""
_CODES = "CASE position_code WHEN 'GK' THEN 'Goalkeeper' WHEN 'DC' THEN 'Defender' WHEN 'MC' THEN 'Midfielder' WHEN 'FW' THEN 'Forward' END"
_LINES = ctes("player_matches", "substitutions", "value_grid")
_NUMBERS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in TOTALS)
ROWS = f"""
{CARRIES}, {ACTIONS}, {VALUED}, {DEFENCE}, {fea.PASSES}, {fea.SHOTS}, {fea.KEEPERS}, {fea.PASS_TOTALS}, {fea.CREATED}, {fea.CARDS}, {fea.ADJUSTED}, {MINUTES},
t_shots AS (SELECT match_id, player_id, count(*) AS shots, sum(is_goal)::BIGINT AS goals, sum(xg) AS xg, sum(xgot) AS xgot FROM shots GROUP BY match_id, player_id),
t_xa AS (SELECT p.match_id, p.player_id, sum(s.xg) AS xa FROM shots s JOIN passes p ON p.match_id = s.match_id AND p.team_id = s.team_id AND p.event_id = s.related_event_id
         GROUP BY p.match_id, p.player_id),
t_carries AS (SELECT match_id, player_id, count(*) AS carries, sum(is_progressive_carry)::BIGINT AS progressive_carries,
                     sum(is_final_third_carry)::BIGINT AS final_third_carries, sum(is_carry_into_box)::BIGINT AS carries_into_box FROM carries GROUP BY match_id, player_id),
t_xt AS (SELECT match_id, player_id, sum(xt_end - xt_start) AS xt_added FROM valued GROUP BY match_id, player_id),
t_def AS (SELECT match_id, player_id, sum(opponent_threat_prevented) AS opponent_threat_prevented, sum(net_threat_reduction) AS defensive_net_threat_reduction
          FROM defence GROUP BY match_id, player_id),
player_rows AS MATERIALIZED (
  SELECT CASE WHEN match_id % 2 = 0 THEN '2024-2025' ELSE '2025-2026' END AS season, match_id, player_id, team_id,
         coalesce({_CODES}, 'Midfielder') AS position_group, minutes, {_NUMBERS}, coalesce(xt_added, 0) / 2 AS xpv_added
  FROM minutes LEFT JOIN t_shots USING (match_id, player_id) LEFT JOIN pass_totals USING (match_id, player_id) LEFT JOIN created USING (match_id, player_id)
  LEFT JOIN t_xa USING (match_id, player_id) LEFT JOIN t_carries USING (match_id, player_id) LEFT JOIN t_xt USING (match_id, player_id)
  LEFT JOIN t_def USING (match_id, player_id) LEFT JOIN cards USING (match_id, player_id) LEFT JOIN adjusted USING (match_id, player_id)
  LEFT JOIN goalkeeping USING (match_id, player_id) WHERE minutes > 0)"""
PRIORS = """
eligible AS (
  SELECT *, max(passes) OVER (PARTITION BY season, position_group) AS top FROM player_rows WHERE position_group IN ('Defender', 'Midfielder', 'Forward')),
prior0 AS (
  SELECT season, position_group, sum(passes)::DOUBLE AS attempted_passes, least(sum(completed_passes), sum(passes))::DOUBLE AS completed_passes, count(*) AS match_rows,
         coalesce(var_samp(least(completed_passes / passes::DOUBLE, 1)) FILTER (WHERE passes > 0), 0) AS observed_variance,
         coalesce(avg(1.0::DOUBLE / passes) FILTER (WHERE passes > 0), 0) AS inverse
  FROM eligible WHERE top < 5 OR passes >= 5 GROUP BY season, position_group),
prior1 AS (SELECT *, CASE WHEN attempted_passes > 0 THEN completed_passes / attempted_passes ELSE 0.75 END AS p FROM prior0),
prior2 AS (SELECT *, p * (1 - p) * inverse AS sampling_variance, least(greatest(observed_variance - p * (1 - p) * inverse, 0.0025), 0.05) AS between_match_variance FROM prior1),
priors AS MATERIALIZED (
  SELECT season, position_group, attempted_passes, completed_passes, match_rows, observed_variance, sampling_variance, between_match_variance,
         p AS pass_completion_prior, least(greatest(p * (1 - p) / between_match_variance - 1, 5), 60) AS prior_strength FROM prior2)"""
_SHORT = "least(greatest(minutes, 30), 90)"
PER90 = f"""
per90 AS MATERIALIZED (
  SELECT *, {", ".join(f"90 * greatest({c}, 0) / {_SHORT} AS {c}_90, ln(1 + 90 * greatest({c}, 0) / {_SHORT}) AS log_{c}_90" for c in rat.LOG_COUNTS)},
         {", ".join(f"90 * {c} / {_SHORT} AS {c}_90" for c in rat.SIGNED)},
         (least(completed_passes, passes) + s * p) / (passes + s) AS smoothed_pass_completion,
         (least(completed_passes, passes) + s * p) / (passes + s) - p AS pass_completion_above_expected,
         least(greatest(goals - xg, -2), 3) AS finishing_above_expected, least(greatest(xgot - xg, -2), 3) AS shot_placement_above_expected,
         greatest(shots_on_target_faced - goals_conceded_xgot_sample, 0)::DOUBLE AS saves,
         CASE WHEN shots_on_target_faced > 0 THEN greatest(shots_on_target_faced - goals_conceded_xgot_sample, 0) / shots_on_target_faced::DOUBLE ELSE 0 END AS save_percentage,
         xgot_faced - goals_conceded_xgot_sample AS goals_prevented
  FROM (SELECT r.*, coalesce(q.pass_completion_prior, 0.75) AS p, coalesce(q.prior_strength, 20) AS s
        FROM player_rows r LEFT JOIN priors q ON q.season = r.season AND q.position_group = r.position_group) t)"""
_FIELD = "position_group IN ('Defender', 'Midfielder', 'Forward')"
LONG = "\n  UNION ALL ".join(
    [f"SELECT season, position_group, '{f}' AS feature, {f}::DOUBLE AS v FROM per90 WHERE {_FIELD}" for f in rat.FEATURES]
    + [
        f"SELECT season, position_group, '{f}', {f}::DOUBLE FROM (SELECT *, max(shots_on_target_faced) OVER (PARTITION BY season) AS most FROM per90 WHERE position_group = 'Goalkeeper') t"
        " WHERE most <= 0 OR shots_on_target_faced > 0"
        for f in rat.KEEPER_FEATURES
    ]
)
STATS = f"""
stats AS MATERIALIZED (
  SELECT season, position_group, feature, avg(v) AS mean, CASE WHEN coalesce(stddev_samp(v), 0) <= 1e-9 THEN 1 ELSE stddev_samp(v) END AS std, count(*) AS sample_size
  FROM ({LONG}) t GROUP BY season, position_group, feature)"""


def _z(feature: str, group: str) -> str:
    stat = f"SELECT %s FROM stats s WHERE s.season = per90.season AND s.position_group = per90.position_group AND s.feature = '{feature}'"
    return f"CASE WHEN {group} THEN least(greatest(({feature} - ({stat % 'mean'})) / ({stat % 'std'}), -4.5), 4.5) END AS z_{feature}"


SCORED = f"""
scored AS MATERIALIZED (
  SELECT *, {", ".join([_z(f, _FIELD) for f in rat.FEATURES] + [_z(f, "position_group = 'Goalkeeper'") for f in rat.KEEPER_FEATURES])} FROM per90)"""
PARTS = f"""
components AS (
  SELECT *, {", ".join(" + ".join(f"z_{f} * {w}" for f, w in terms.items()) + f" AS {name}" for name, terms in rat.COMPONENTS.items())} FROM scored)"""
_WEIGHTED = "CASE position_group " + " ".join(
    f"WHEN '{g}' THEN " + " + ".join(f"{c} * {w}" for c, w in zip(rat.COMPONENTS, ws, strict=True)) for g, ws in rat.WEIGHTS.items()
) + " END"
COMPOSED = f"""
composed AS MATERIALIZED (
  SELECT *, raw_position_composite * minutes_reliability AS reliability_adjusted_composite
  FROM (SELECT *, {_WEIGHTED} AS raw_position_composite, 0.25 + 0.75 * sqrt(least(minutes / 90, 1)) AS minutes_reliability FROM components) t),
again AS (
  SELECT season, position_group, 'reliability_adjusted_composite' AS feature, avg(reliability_adjusted_composite) AS mean,
         CASE WHEN coalesce(stddev_samp(reliability_adjusted_composite), 0) <= 1e-9 THEN 1 ELSE stddev_samp(reliability_adjusted_composite) END AS std, count(*) AS sample_size
  FROM composed WHERE {_FIELD} AND minutes > 0 GROUP BY season, position_group)"""
RATED = """
based AS (
  SELECT c.*, z AS standardized_composite, CASE WHEN c.position_group = 'Goalkeeper'
           THEN 6 + sqrt(least(shots_on_target_faced / 5.0::DOUBLE, 1)) * (0.8 * z_goals_prevented + 0.2 * z_save_percentage)
                + CASE WHEN goals_conceded = 0 AND shots_on_target_faced >= 3 THEN 0.15 ELSE 0 END
           ELSE 6 + 3.3 * tanh(z / 3.3) END AS base_rating
  FROM (SELECT c.*, least(greatest((reliability_adjusted_composite - a.mean) / a.std, -5), 5) AS z
        FROM composed c LEFT JOIN again a ON a.season = c.season AND a.position_group = c.position_group) c),
adjusted_ratings AS (
  SELECT *, least(greatest(0.1 * least(goals, 3) + 0.05 * least(assists, 2) + 0.05 * least(greatest(assists - xa, 0), 2), 0), 0.5)::DOUBLE AS decisive_action_bonus,
         (0.15 * yellow_cards + 1.25 * red_cards)::DOUBLE AS card_penalty, least(0.1 * big_chances_missed, 0.3)::DOUBLE AS big_chance_miss_penalty,
         least(0.7 * own_goals, 1.4)::DOUBLE AS own_goal_penalty FROM based),
ratings AS (
  SELECT *, least(greatest(base_rating + decisive_action_bonus - card_penalty - big_chance_miss_penalty - own_goal_penalty, 1), 10) AS post_match_rating FROM adjusted_ratings)"""
_R = f"WITH {_LINES}, {ROWS}"
_P = f"{_R}, {PRIORS}, {PER90}"
_Z = f"{_P}, {STATS}, {SCORED}"
_C = f"{_Z}, {PARTS}, {COMPOSED}"
_PRIMARY = """
starts AS (SELECT season, player_id, position_group, count(*) AS n FROM lineups WHERE started = 1 AND position_group <> 'Unknown' GROUP BY season, player_id, position_group),
season_best AS (SELECT season, player_id, position_group AS primary_position, n AS position_starts
  FROM starts QUALIFY row_number() OVER (PARTITION BY season, player_id ORDER BY n DESC, position_group) = 1),
career_best AS (SELECT player_id, position_group AS primary_position FROM (SELECT player_id, position_group, sum(n) AS n FROM starts GROUP BY player_id, position_group) t
  QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY n DESC, position_group) = 1)"""
_LINEUPS = f"""lineups AS (SELECT match_id, player_id, started, CASE WHEN match_id % 2 = 0 THEN '2024-2025' ELSE '2025-2026' END AS season,
  coalesce({_CODES}, 'Unknown') AS position_group FROM player_matches)"""

ORACLES = {
    "appearance_minutes": f"WITH {_LINES}, {MINUTES} SELECT match_id, player_id, minutes, minutes_source FROM minutes",
    "position_group_map": f"WITH {ctes('player_matches')} SELECT match_id, player_id, coalesce({_CODES}, 'Unknown') AS strict, {_CODES} AS lenient, CASE position_code WHEN 'GK' THEN 'Goalkeeper' WHEN 'FW' THEN 'Forward' ELSE 'Unknown' END AS synonym FROM player_matches",
    "propagate_positions": f"""WITH RECURSIVE {_LINES}, pairs AS (SELECT DISTINCT match_id, player_id, related_player_id AS replaced FROM substitutions),
        start AS (SELECT match_id, player_id, {_CODES} AS g FROM player_matches),
        chain AS (SELECT match_id, player_id, g, 0 AS depth FROM start WHERE g IS NOT NULL
          UNION SELECT p.match_id, p.player_id, c.g, c.depth + 1 FROM chain c JOIN pairs p ON p.match_id = c.match_id AND p.replaced = c.player_id
          JOIN start s ON s.match_id = p.match_id AND s.player_id = p.player_id WHERE s.g IS NULL AND c.depth < 30),
        first AS (SELECT match_id, player_id, g FROM chain QUALIFY row_number() OVER (PARTITION BY match_id, player_id ORDER BY depth, g) = 1)
        SELECT s.match_id, s.player_id, f.g AS position_group FROM start s LEFT JOIN first f ON f.match_id = s.match_id AND f.player_id = s.player_id""",
    "player_match_features": rounded_sql(f"{_R} SELECT season, match_id, player_id, team_id, position_group, minutes, {', '.join(TOTALS)} FROM player_rows", _DOUBLE_TOTALS),
    "enrich_increment": rounded_sql(f"""{_R}, work AS (SELECT DISTINCT match_id FROM match_events WHERE match_id % 3 = 0)
        SELECT w.match_id, CASE WHEN w.match_id % 9 = 0 THEN 'failed' ELSE 'processed' END AS status, CASE WHEN w.match_id % 9 = 0 THEN 'invalid minutes' END AS error,
               p.player_id, p.minutes, {', '.join('p.' + c for c in TOTALS)}
        FROM work w LEFT JOIN player_rows p ON p.match_id = w.match_id AND w.match_id % 9 > 0""", ["minutes", *_DOUBLE_TOTALS]),
    "pass_completion_prior": rounded_sql(f"{_R}, {PRIORS} SELECT * FROM priors", ["observed_variance", "sampling_variance", "between_match_variance", "pass_completion_prior", "prior_strength"]),
    "per90_log_features": rounded_sql(f"{_P} SELECT match_id, player_id, {', '.join(_PER90)} FROM per90", list(_PER90)),
    "zscore_fit": rounded_sql(f"{_P}, {STATS} SELECT * FROM stats", ["mean", "std"]),
    "zscore_apply": rounded_sql(f"{_Z} SELECT match_id, player_id, {', '.join(f'z_{f}' for f in _ALL)} FROM scored", [f"z_{f}" for f in _ALL]),
    "rating_components": rounded_sql(f"{_Z}, {PARTS} SELECT match_id, player_id, {', '.join(rat.COMPONENTS)} FROM components", list(rat.COMPONENTS)),
    "position_composite": rounded_sql(f"{_C} SELECT match_id, player_id, raw_position_composite, minutes_reliability, reliability_adjusted_composite FROM composed", ["raw_position_composite", "minutes_reliability", "reliability_adjusted_composite"]),
    "composite_restandardize": rounded_sql(f"{_C} SELECT * FROM again", ["mean", "std"]),
    "outfield_rating": rounded_sql(f"{_C}, {RATED} SELECT match_id, player_id, standardized_composite, base_rating FROM ratings WHERE position_group <> 'Goalkeeper'", ["standardized_composite", "base_rating"]),
    "goalkeeper_rating": rounded_sql(f"{_C}, {RATED} SELECT match_id, player_id, base_rating FROM ratings WHERE position_group = 'Goalkeeper'", ["base_rating"]),
    "rating_adjustments": rounded_sql(f"{_C}, {RATED} SELECT match_id, player_id, decisive_action_bonus, card_penalty, big_chance_miss_penalty, own_goal_penalty, post_match_rating FROM ratings", ["decisive_action_bonus", "card_penalty", "big_chance_miss_penalty", "own_goal_penalty", "post_match_rating"]),
    "materialize": rounded_sql(f"""{_C}, {RATED}, dated AS (SELECT player_id, match_id, DATE '2024-08-01' + match_id::INT AS d, minutes AS m, post_match_rating AS r FROM ratings),
        newest AS (SELECT * FROM dated QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY d DESC, match_id DESC) = 1),
        form AS (SELECT n.player_id, sum(x.m * x.r * pow(2.0::DOUBLE, -(n.d - x.d) / 90.0::DOUBLE)) / sum(x.m * pow(2.0::DOUBLE, -(n.d - x.d) / 90.0::DOUBLE)) AS f
                 FROM newest n JOIN dated x ON x.player_id = n.player_id GROUP BY n.player_id)
        SELECT n.player_id, n.match_id, r AS rating, f AS form_rating_ewm, r - 6 AS impact, CASE WHEN r > 6.25 THEN 'positive' WHEN r < 5.75 THEN 'negative' ELSE 'neutral' END AS impact_label
        FROM newest n JOIN form USING (player_id)""", ["rating", "form_rating_ewm", "impact"]),
    "primary_position": f"WITH {ctes('player_matches')}, {_LINEUPS}, {_PRIMARY} SELECT * FROM season_best",
    "apply_primary_position": f"""WITH {ctes('player_matches')}, {_LINEUPS}, {_PRIMARY}
        SELECT l.match_id, l.player_id, CASE WHEN started = 1 THEN l.position_group ELSE coalesce(s.primary_position, c.primary_position) END AS position_group
        FROM lineups l LEFT JOIN season_best s ON s.season = l.season AND s.player_id = l.player_id LEFT JOIN career_best c ON c.player_id = l.player_id""",
    "rating_validate": f"""WITH {ctes('player_ratings')} SELECT sum(n)::BIGINT AS n_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys, sum(bad)::BIGINT AS out_of_range,
        count(*) FILTER (WHERE n > 1) = 0 AND sum(bad) = 0 AS valid
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE NOT rating BETWEEN 1 AND 10) AS bad FROM player_ratings GROUP BY year(match_date), match_id, player_id) t""",
}
