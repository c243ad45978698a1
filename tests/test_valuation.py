"""Valuation intervals on hand-made rows, and running sums against the join that they replace."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tempoframe.operators import valuation as val

DAY = dt.date(2024, 1, 1)
RATING = "player_id long, match_id long, match_date date, minutes double, rating double, position_group string, started int, player_name string, goals double, xg double, threat_component double"


def day(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def hand(spark):
    values = spark.createDataFrame([(1, day(0), 100, 20.0), (1, day(100), 200, 21.0), (1, day(105), 210, 21.0), (2, day(0), 5, 30.0)], "player_id long, valuation_date date, market_value long, age_at_valuation double")
    rows = [
        (1, 1, day(0), 90.0, 9.0, "GK", 1, "old", 1.0, 0.1, 1.0),  # the day of the first value: before the interval
        (1, 2, day(10), 0.0, 2.0, "Defender", 0, "A", 0.0, 0.2, 5.0),
        (1, 3, day(20), 125.0, 6.0, "Midfielder", 1, "B", 2.0, None, 1.0),
        (1, 4, day(95), 60.0, 8.0, None, 1, None, 1.0, 0.4, None),
        (1, 5, day(100), 90.0, 1.0, "Forward", 1, "C", 9.0, 9.0, 9.0),  # the day of the value: after the interval
        (1, 6, day(50), 90.0, None, "Forward", 1, "C", 9.0, 9.0, 9.0),
    ]
    ratings = val.ratings_prepare(spark.createDataFrame(rows, RATING))
    return val.valuation_intervals(val.valuation_clean(values), ratings), ratings, values


def test_means_weigh_by_minutes(hand):
    intervals, ratings, _ = hand
    (r,) = val.interval_performance(intervals, ratings).collect()
    assert (r.matches, r.starts, r.minutes, r.latest_position, r.player_name) == (3, 2, 185.0, "Midfielder", "B")
    assert r.mean_rating == pytest.approx((125 * 6 + 60 * 8) / 185)  # no minutes weigh nothing, 125 weigh as they are
    decayed = [(m, x, 2 ** (-d / 90)) for m, x, d in ((1, 2, 90), (120, 6, 80), (60, 8, 5))]
    assert r.decayed_rating == pytest.approx(sum(m * x * w for m, x, w in decayed) / sum(m * w for m, _, w in decayed))
    assert r.last_90_rating == pytest.approx((125 * 6 + 60 * 8) / 185)
    assert r.mean_threat_component == pytest.approx(1.0) and (r.goals, r.xg) == (3.0, pytest.approx(0.6))


def test_form_counts_all_earlier_matches(hand):
    intervals, ratings, _ = hand
    (r,) = val.rolling_asof_form(intervals, ratings).collect()
    assert r.asof_last_3 == pytest.approx((125 * 6 + 60 * 8) / 185)
    assert r.asof_last_20 == pytest.approx((90 * 9 + 125 * 6 + 60 * 8) / 275) and (r.matches_last_3, r.matches_last_20) == (3, 4)


def test_features(hand):
    intervals, ratings, values = hand
    (r,) = val.valuation_feature_table(intervals, ratings).collect()
    assert r.rating_trend == pytest.approx(r.last_90_rating - r.mean_rating) and r.start_share == pytest.approx(2 / 3)
    assert r.age_squared == 441.0 and r.goals_per90 == pytest.approx(3 * 90 / 185) and r.goals_over_xg_per90 == pytest.approx(2.4 * 90 / 185)
    assert r.log_previous_value == pytest.approx(4.605170186)
    (now,) = val.current_asof_features(values, ratings, "2024-04-09").collect()
    assert (now.player_id, now.previous_valuation_date) == (1, day(0)) and now.age_at_valuation == pytest.approx(20 + 99 / 365.25)
    scored = intervals.withColumns({"predicted_pct_change": F.lit(0.25), "probability_rise": F.lit(0.5)})
    (s,) = val.dataset_summary(scored).collect()
    assert (s.n_rows, s.mean_predicted_change, s.mean_probability_rise) == (1, 0.25, 0.5)


def test_columns_that_are_absent(spark):
    rows = val.ratings_prepare(spark.createDataFrame([(1, 1, day(1), None, 5.0)], "player_id long, match_id long, match_date date, minutes double, rating double"))
    (r,) = rows.collect()
    assert (r.minutes, r.started, r.goals, r.threat_component, r.player_name) == (0.0, 0, 0.0, None, None)


def test_running_sums_equal_the_join(spark):
    rng = random.Random(1)
    rows = [(p, p * 1000 + k, day(rng.randrange(500)), float(rng.choice([0, 1, 45, 90, 125])), rng.random() * 9, "x", 1, "n", 0.0, 0.0, None) for p in range(6) for k in range(60)]
    ratings = val.ratings_prepare(spark.createDataFrame(rows, RATING))
    values = spark.createDataFrame([(p, day(rng.randrange(500)), 10 + k) for p in range(6) for k in range(12)], "player_id long, valuation_date date, market_value long")
    intervals = val.valuation_intervals(val.valuation_clean(values), ratings)
    joined = val.interval_asof_join(intervals, ratings)
    ok = lambda k: F.col("recency_rank") <= k
    want = joined.groupBy("player_id", "valuation_date").agg(
        val.weighted_mean_if("rating", "decayed_weight").alias("asof_form"), *(val.weighted_mean_if("rating", "minutes", ok(k)).alias(f"asof_last_{k}") for k in (3, 20)), F.count("*").alias("n")
    )
    got = {(r.player_id, r.valuation_date): r for r in val.rolling_asof_form(intervals, ratings).collect()}
    found = want.collect()
    assert len(found) == len(got) > 20
    for r in found:
        g = got[(r.player_id, r.valuation_date)]
        assert g.asof_form == pytest.approx(r.asof_form) and g.matches_last_20 == min(20, r.n)
        assert g.asof_last_3 == (None if r.asof_last_3 is None else pytest.approx(r.asof_last_3)) and g.asof_last_20 == pytest.approx(r.asof_last_20)
