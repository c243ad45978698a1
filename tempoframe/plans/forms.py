"""Queries over form and valuations, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.functions.state import written
from tempoframe.operators import form as frm
from tempoframe.operators import ledger as led
from tempoframe.operators import valuation as val
from tempoframe.plans.fixtures import ctes, dealt, parts, projected

#: Rows from this date on count as new.
SPLIT = "1997-01-01"
AS_OF = "1998-01-01"


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(spark, sf_dir, "player_ratings")


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.valuation_clean(projected(spark, sf_dir, "player_valuations"))


def form_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form after every match."""
    made = frm.form_history(_ratings(spark, sf_dir))
    return rounded(made.select("player_id", "match_id", "form_rating_ewm", "rolling_3_match_rating", "rolling_20_match_rating"))


def _flat(state: DataFrame) -> DataFrame:
    ids = F.array_join(F.transform("recent", lambda r: r["match_id"].cast("string")), ",")
    return rounded(state.select("player_id", "ewm_numerator", "ewm_denominator", F.col("last_match_date").cast("string").alias("last_match_date"), ids.alias("recent_ids")))


def form_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final form state of every player."""
    return _flat(frm.form_state(_ratings(spark, sf_dir)))


def form_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of older rows, continued with the newer ones."""
    rows = _ratings(spark, sf_dir)
    return _flat(frm.form_append(frm.form_state(rows.where(F.col("match_date") < SPLIT)), rows.where(F.col("match_date") >= SPLIT)))


def _hashes(rows: DataFrame, edited: bool) -> DataFrame:
    shift = F.when(F.col("match_id") % 7 == 0, 1).otherwise(0) if edited else F.lit(0)
    return rows.select("match_id", F.md5((F.col("n") + shift).cast("string").cast("binary")).alias("input_hash"))


def changed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and changed matches."""
    sums = written(_ratings(spark, sf_dir).groupBy("match_id").agg(F.sum(F.round(F.col("rating") * 100).cast("long")).alias("n")), "sums")
    n = parts(spark, sf_dir)
    return frm.changed_partitions(dealt(_hashes(sums, True), n, "match_id"), dealt(_hashes(sums, False).where("match_id % 5 <> 0"), n, "match_id"))


def _stored(rows: DataFrame) -> DataFrame:
    """What was known before: a part of the matches is still to come, a part is late and a part had other ratings."""
    known = rows.where((F.col("match_date") < SPLIT) & (F.col("match_id") % 11 > 0))
    return known.withColumn("rating", F.when(F.col("match_id") % 7 == 0, F.col("rating") - 1).otherwise(F.col("rating")))


def _edits(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Retractions and insertions between the known and the current rows of matches whose digests differ."""
    digest = lambda df: df.groupBy("match_id").agg(F.bit_xor(F.xxhash64("player_id", "minutes", "rating", "match_date")).cast("string").alias("input_hash"))
    changes = frm.changed_partitions(digest(rows), digest(known))
    return led.edits_between(known, rows, changes)


def _by_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ratings, written once and dealt by player."""
    rows = written(_ratings(spark, sf_dir).select("player_id", "match_id", "match_date", "minutes", "rating"), "current")
    return dealt(rows, parts(spark, sf_dir), "player_id")


def incremental_rating_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with form, brought up to date with new, late and corrected rows, each player by its own route."""
    rows = _by_player(spark, sf_dir)
    known = dealt(written(_stored(rows), "known"), parts(spark, sf_dir), "player_id")
    history = led.advanced(frm.form_history(known), led.form_ledger(known), _edits(rows, known))[0]
    return rounded(history.select("player_id", "match_id", "form_rating_ewm", "rolling_3_match_rating", "rolling_20_match_rating"))


def late_row_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each player's route when some matches come in, many of them late, and the state that it leads to."""
    rows = _by_player(spark, sf_dir)
    known = rows.where("match_id % 5 <> 0")
    edits = rows.where("match_id % 5 = 0").withColumn("op", F.lit("insert"))
    _, ledger, routes = led.advanced(frm.form_history(known), led.form_ledger(known), edits)
    states = led.state_of(ledger).join(routes, "player_id", "left").withColumn("route", F.coalesce("route", F.lit("reuse")))
    return _flat(states).join(states.select("player_id", "route"), "player_id")


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.ratings_prepare(dealt(projected(spark, sf_dir, "rated_matches"), parts(spark, sf_dir), "player_id"))


def valuation_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean valuations."""
    return rounded(_values(spark, sf_dir))


def ratings_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared ratings."""
    return rounded(_matches(spark, sf_dir))


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.valuation_intervals(_values(spark, sf_dir), _matches(spark, sf_dir))


def valuation_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valuation intervals."""
    return rounded(_intervals(spark, sf_dir))


def interval_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals with all earlier ratings."""
    matches = written(_matches(spark, sf_dir).select("player_id", "match_id", "match_date", "minutes", "rating"), "matches")
    made = val.interval_asof_join(val.valuation_intervals(_values(spark, sf_dir), matches), matches)
    return rounded(made.select("player_id", "valuation_date", "match_id", "days_before", "recency_rank", "minutes", "decayed_weight"))


def rolling_asof_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form at every valuation."""
    return rounded(val.rolling_asof_form(_intervals(spark, sf_dir), _matches(spark, sf_dir), parts=parts(spark, sf_dir)))


def interval_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance within every interval."""
    return rounded(val.interval_performance(_intervals(spark, sf_dir), _matches(spark, sf_dir), parts=parts(spark, sf_dir)))


def weighted_mean_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean ratings weighted by minutes, of all and of long matches, by player."""
    return rounded(_ratings(spark, sf_dir).groupBy("player_id").agg(
        val.weighted_mean_if("rating", "minutes").alias("mean_rating"), val.weighted_mean_if("rating", "minutes", F.col("minutes") >= 60).alias("long_rating")
    ))


_PER_90 = (*(f"{c}_per90" for c in val.SUMMED), "goals_over_xg_per90", "assists_over_xa_per90")
_FEATURES = (
    "player_id", "valuation_date", "days_between", "log_value_change", "pct_value_change", "previous_log_change", "age_at_valuation", "age_squared", "matches", "starts", "start_share",
    "minutes", "latest_position", "player_name", "mean_rating", "decayed_rating", "last_90_rating", "rating_std", "asof_form", "asof_last_3", "asof_last_20", "matches_last_3",
    "matches_last_20", "log_previous_value", "log_minutes", "log_matches", "valuation_year", "month_sin", "month_cos", "rating_trend", *(f"mean_{c}" for c in val.COMPONENTS), *val.SUMMED, *_PER_90,
)


def valuation_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of all intervals."""
    matches = written(_matches(spark, sf_dir), "matches")
    intervals = written(val.valuation_intervals(_values(spark, sf_dir), matches), "intervals")
    made = val.valuation_feature_table(intervals, matches, parts=parts(spark, sf_dir))
    return rounded(made.select(*_FEATURES))


_NOW = tuple(c for c in _FEATURES if c not in ("log_value_change", "pct_value_change"))


def current_asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of all players as of a day."""
    return rounded(val.current_asof_features(_values(spark, sf_dir), _matches(spark, sf_dir), AS_OF).select(*_NOW))


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of the feature rows."""
    return val.dataset_summary(valuation_feature_table(spark, sf_dir))


QUERIES = (
    form_history, form_state, form_append, changed_partitions, incremental_rating_update, late_row_route, valuation_clean, ratings_prepare, valuation_intervals,
    interval_asof_join, rolling_asof_form, interval_performance, weighted_mean_if, valuation_feature_table, current_asof_features, dataset_summary,
)

_R, _V, _M = ctes("player_ratings"), ctes("player_valuations"), ctes("rated_matches")
_FORM = f"""WITH {_R}, used AS (SELECT *, rating IS NOT NULL AND minutes > 0 AS ok FROM player_ratings),
pairs AS (
  SELECT a.player_id, a.match_id, b.minutes AS m, b.rating AS r, pow(2.0::DOUBLE, -date_diff('day', b.match_date, a.match_date) / 90.0::DOUBLE) AS f,
         row_number() OVER (PARTITION BY a.player_id, a.match_id ORDER BY b.match_date DESC, b.match_id DESC) AS k
  FROM used a JOIN used b ON b.player_id = a.player_id AND (b.match_date, b.match_id) <= (a.match_date, a.match_id) WHERE b.ok),
sums AS (
  SELECT player_id, match_id, sum(m * r * f) / sum(m * f) AS form_rating_ewm, sum(m * r) FILTER (WHERE k <= 3) / sum(m) FILTER (WHERE k <= 3) AS rolling_3_match_rating,
         sum(m * r) FILTER (WHERE k <= 20) / sum(m) FILTER (WHERE k <= 20) AS rolling_20_match_rating FROM pairs GROUP BY player_id, match_id)
SELECT u.player_id, u.match_id, form_rating_ewm, rolling_3_match_rating, rolling_20_match_rating
FROM used u LEFT JOIN sums s ON s.player_id = u.player_id AND s.match_id = u.match_id"""
_STATE = f"""WITH {_R}, last AS (SELECT player_id, max(match_date) AS d FROM player_ratings GROUP BY player_id),
used AS (SELECT r.*, pow(2.0::DOUBLE, -date_diff('day', match_date, l.d) / 90.0::DOUBLE) AS f,
                row_number() OVER (PARTITION BY r.player_id ORDER BY match_date DESC, match_id DESC) AS k
         FROM player_ratings r JOIN last l ON l.player_id = r.player_id WHERE rating IS NOT NULL AND minutes > 0)
SELECT l.player_id, coalesce(sum(minutes * rating * f), 0) AS ewm_numerator, coalesce(sum(minutes * f), 0) AS ewm_denominator, l.d::VARCHAR AS last_match_date,
       coalesce(string_agg(match_id::VARCHAR, ',' ORDER BY match_date, match_id) FILTER (WHERE k <= 20), '') AS recent_ids
FROM last l LEFT JOIN used u ON u.player_id = l.player_id GROUP BY l.player_id, l.d"""
_CLEAN = "clean AS (SELECT player_id, valuation_date, max(market_value) AS market_value, max(age_at_valuation) AS age_at_valuation FROM player_valuations WHERE market_value > 0 GROUP BY player_id, valuation_date)"
_PREPARED = f"""prepared AS (
  SELECT * REPLACE (coalesce(minutes, 0) AS minutes, coalesce(started, 0)::BIGINT AS started, {', '.join(f'coalesce({c}, 0) AS {c}' for c in val.SUMMED)}) FROM rated_matches WHERE rating IS NOT NULL)"""
_LAGGED = """lagged AS (
  SELECT player_id, valuation_date, market_value::DOUBLE AS market_value, age_at_valuation, lag(valuation_date) OVER w AS previous_valuation_date,
         (lag(market_value) OVER w)::DOUBLE AS previous_value, (lag(market_value, 2) OVER w)::DOUBLE AS before
  FROM clean WHERE player_id IN (SELECT player_id FROM prepared) WINDOW w AS (PARTITION BY player_id ORDER BY valuation_date)),
intervals AS (
  SELECT player_id, valuation_date, market_value, age_at_valuation, previous_valuation_date, previous_value,
         date_diff('day', previous_valuation_date, valuation_date) AS days_between, ln(market_value / previous_value) AS log_value_change,
         market_value / previous_value - 1 AS pct_value_change, ln(previous_value / before) AS previous_log_change
  FROM lagged WHERE date_diff('day', previous_valuation_date, valuation_date) BETWEEN 14 AND 365)"""


def _mean(value: str, weight: str, condition: str = "TRUE") -> str:
    ok = f"FILTER (WHERE {value} IS NOT NULL AND {condition})"
    return f"CASE WHEN sum({weight}) {ok} > 0 THEN sum({value} * {weight}) {ok} / sum({weight}) {ok} END"


_ASOF = f"""joined AS (
  SELECT i.previous_valuation_date, i.valuation_date, r.*, date_diff('day', r.match_date, i.valuation_date) AS days_before,
         least(greatest(minutes, 1), 120) * pow(2.0::DOUBLE, -date_diff('day', r.match_date, i.valuation_date) / 90.0::DOUBLE) AS decayed_weight,
         row_number() OVER (PARTITION BY i.player_id, i.valuation_date ORDER BY r.match_date DESC, r.match_id DESC) AS recency_rank
  FROM intervals i JOIN prepared r ON r.player_id = i.player_id AND r.match_date < i.valuation_date),
rolling AS (
  SELECT player_id, valuation_date, sum(rating * decayed_weight) / sum(decayed_weight) AS asof_form, {_mean('rating', 'minutes', 'recency_rank <= 3')} AS asof_last_3,
         {_mean('rating', 'minutes', 'recency_rank <= 20')} AS asof_last_20, least(count(*), 3) AS matches_last_3, least(count(*), 20) AS matches_last_20
  FROM joined GROUP BY player_id, valuation_date),
performance AS (
  SELECT player_id, valuation_date, count(DISTINCT match_id) AS matches, sum(started)::BIGINT AS starts, sum(minutes) AS minutes,
         arg_max(position_group, (match_date, match_id)) FILTER (WHERE position_group IS NOT NULL) AS latest_position,
         arg_max(player_name, (match_date, match_id)) FILTER (WHERE player_name IS NOT NULL) AS player_name,
         {_mean('rating', 'minutes')} AS mean_rating, {_mean('rating', 'decayed_weight')} AS decayed_rating, {_mean('rating', 'minutes', 'days_before <= 90')} AS last_90_rating,
         coalesce(stddev_samp(rating), 0) AS rating_std, {', '.join(f"{_mean(c, 'minutes')} AS mean_{c}" for c in val.COMPONENTS)}, {', '.join(f'sum({c}) AS {c}' for c in val.SUMMED)}
  FROM joined WHERE match_date > previous_valuation_date GROUP BY player_id, valuation_date),
feature_rows AS (
  SELECT i.*, p.* EXCLUDE (player_id, valuation_date), r.* EXCLUDE (player_id, valuation_date), ln(previous_value) AS log_previous_value, ln(1 + minutes) AS log_minutes,
         ln(1 + matches) AS log_matches, starts / matches AS start_share, age_at_valuation * age_at_valuation AS age_squared, year(i.valuation_date) AS valuation_year,
         sin(month(i.valuation_date) * 2 * pi() / 12) AS month_sin, cos(month(i.valuation_date) * 2 * pi() / 12) AS month_cos, last_90_rating - mean_rating AS rating_trend,
         {', '.join(f'{c} * 90 / minutes AS {c}_per90' for c in val.SUMMED)}, (goals - xg) * 90 / minutes AS goals_over_xg_per90, (assists - xa) * 90 / minutes AS assists_over_xa_per90
  FROM intervals i JOIN performance p ON p.player_id = i.player_id AND p.valuation_date = i.valuation_date
  LEFT JOIN rolling r ON r.player_id = i.player_id AND r.valuation_date = i.valuation_date)"""
#: Clean valuations and prepared matches, and what is built on ``intervals`` over them, for other modules too.
VALUES, AS_OF_SQL = f"{_V}, {_M}, {_CLEAN}, {_PREPARED}", _ASOF
_I = f"WITH {VALUES}, {_LAGGED}"
_J = f"{_I}, {_ASOF}"
_PSEUDO = f"""intervals AS (
  SELECT player_id, DATE '{AS_OF}' AS valuation_date, max(valuation_date) AS previous_valuation_date, arg_max(market_value, valuation_date)::DOUBLE AS previous_value,
         date_diff('day', max(valuation_date), DATE '{AS_OF}') AS days_between,
         arg_max(age_at_valuation, valuation_date) + date_diff('day', max(valuation_date), DATE '{AS_OF}') / 365.25::DOUBLE AS age_at_valuation,
         ln(max(market_value) FILTER (WHERE k = 1)::DOUBLE / max(market_value) FILTER (WHERE k = 2)) AS previous_log_change
  FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY valuation_date DESC) AS k FROM clean WHERE valuation_date < DATE '{AS_OF}') t GROUP BY player_id)"""
_FORMS = ["form_rating_ewm", "rolling_3_match_rating", "rolling_20_match_rating"]
_WHOLE = ("player_id", "valuation_date", "days_between", "matches", "starts", "latest_position", "player_name", "matches_last_3", "matches_last_20", "valuation_year")
_FEATURE_DOUBLES = [c for c in _FEATURES if c not in _WHOLE]
_HASH = "SELECT match_id, sum(round(rating * 100)::BIGINT) AS n FROM player_ratings GROUP BY match_id"

ORACLES = {
    "form_history": rounded_sql(_FORM, _FORMS),
    "form_state": rounded_sql(_STATE, ["ewm_numerator", "ewm_denominator"]),
    "form_append": rounded_sql(_STATE, ["ewm_numerator", "ewm_denominator"]),
    "changed_partitions": f"""WITH {_R}, s AS ({_HASH})
        SELECT match_id, md5((n + CASE WHEN match_id % 7 = 0 THEN 1 ELSE 0 END)::VARCHAR) AS input_hash, CASE WHEN match_id % 5 = 0 THEN 'new' ELSE 'changed' END AS status
        FROM s WHERE match_id % 5 = 0 OR match_id % 7 = 0""",
    "incremental_rating_update": rounded_sql(_FORM, _FORMS),
    "late_row_route": rounded_sql(f"""WITH {_R}, place AS (SELECT *, date_diff('day', DATE '1990-01-01', match_date)::BIGINT * 10000000000 + match_id AS pos FROM player_ratings),
        known AS (SELECT player_id, max(pos) AS last FROM place WHERE match_id % 5 <> 0 GROUP BY player_id),
        r AS (SELECT p.player_id, bool_or(coalesce(p.pos <= k.last, false)) AS late FROM place p LEFT JOIN known k ON k.player_id = p.player_id WHERE p.match_id % 5 = 0 GROUP BY p.player_id)
        SELECT s.*, CASE WHEN r.late THEN 'recompute' WHEN r.player_id IS NOT NULL THEN 'append' ELSE 'reuse' END AS route FROM ({_STATE}) s LEFT JOIN r ON r.player_id = s.player_id""", ["ewm_numerator", "ewm_denominator"]),
    "valuation_clean": rounded_sql(f"WITH {_V}, {_CLEAN} SELECT * FROM clean", ["age_at_valuation"]),
    "ratings_prepare": rounded_sql(f"WITH {_M}, {_PREPARED} SELECT * FROM prepared", ["minutes", "rating", *val.SUMMED, *val.COMPONENTS]),
    "valuation_intervals": rounded_sql(f"{_I} SELECT * FROM intervals", ["market_value", "previous_value", "log_value_change", "pct_value_change", "previous_log_change", "age_at_valuation"]),
    "interval_asof_join": rounded_sql(f"{_J} SELECT player_id, valuation_date, match_id, days_before, recency_rank, minutes, decayed_weight FROM joined", ["minutes", "decayed_weight"]),
    "rolling_asof_form": rounded_sql(f"{_J} SELECT * FROM rolling", ["asof_form", "asof_last_3", "asof_last_20"]),
    "interval_performance": rounded_sql(f"{_J} SELECT * FROM performance", ["minutes", "mean_rating", "decayed_rating", "last_90_rating", "rating_std", *(f"mean_{c}" for c in val.COMPONENTS), *val.SUMMED]),
    "weighted_mean_if": rounded_sql(f"""WITH {_R} SELECT player_id, CASE WHEN sum(minutes) > 0 THEN sum(rating * minutes) / sum(minutes) END AS mean_rating,
        CASE WHEN sum(minutes) FILTER (WHERE minutes >= 60) > 0 THEN sum(rating * minutes) FILTER (WHERE minutes >= 60) / sum(minutes) FILTER (WHERE minutes >= 60) END AS long_rating
        FROM player_ratings GROUP BY player_id""", ["mean_rating", "long_rating"]),
    "valuation_feature_table": rounded_sql(f"{_J} SELECT {', '.join(_FEATURES)} FROM feature_rows WHERE minutes >= 180", _FEATURE_DOUBLES),
    "current_asof_features": rounded_sql(f"WITH {_V}, {_M}, {_CLEAN}, {_PREPARED}, {_PSEUDO}, {_ASOF} SELECT {', '.join(_NOW)} FROM feature_rows WHERE minutes >= 1", [c for c in _FEATURE_DOUBLES if c in _NOW]),
    "dataset_summary": f"{_J} SELECT count(*) AS n_rows, count(DISTINCT player_id) AS players, min(valuation_date) AS first_date, max(valuation_date) AS last_date FROM feature_rows WHERE minutes >= 180",
}
