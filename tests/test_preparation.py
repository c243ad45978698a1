"""Fitted preparation, level codes, least squares and stored models, by value."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoframe.operators import chain, models, preparation, regression


def test_later_rows_go_through_what_was_fitted(spark):
    rows = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 3.0, None), (4, 8.0, "b")], "id long, x double, p string")
    ready = preparation.fit_preparation(rows.withColumn("z", F.lit(None).cast("double")), ["x", "z"], "p")
    filled = np.array([1.0, 3.0, 3.0, 8.0])
    assert ready.medians == (3.0, 0.0) and ready.levels == ("a", "b") and ready.deviations[1] == 1.0
    later = spark.createDataFrame([(9, 100.0, None, "c"), (8, None, 2.0, "c")], "id long, x double, z double, p string")
    got = {r.id: (r.x, r.z) for r in ready.apply(later).collect()}
    assert got[9] == (pytest.approx((100 - filled.mean()) / filled.std()), 0.0) and got[8] == (pytest.approx((3 - filled.mean()) / filled.std()), 2.0)
    with pytest.raises(ValueError, match="lack columns"):
        ready.apply(later.drop("z"))


def test_preparation_is_the_same_after_storage(spark, tmp_path):
    rows = spark.createDataFrame([(0.1 * i, 1 / 3 + i, f"p{i % 3}") for i in range(20)], "x double, y double, p string")
    ready = preparation.fit_preparation(rows, ["x", "y"], "p")
    path = ready.save(spark, f"file://{tmp_path}/p")
    assert preparation.Preparation.load(spark, path) == ready


def test_codes_of_many_levels(spark):
    rows = spark.range(3000).select(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")).alias("level")).repartition(7)
    codes = preparation.fit_codes(rows, "level")
    want = {v: i for i, v in enumerate(sorted({f"k{i}" for i in range(1000)}))}
    assert {r.level: r.code for r in codes.collect()} == want
    asked = spark.createDataFrame([("k5",), ("new",), (None,)], "level string")
    assert {r.level: r.level_code for r in preparation.apply_codes(asked, codes, "level").collect()} == {"k5": want["k5"], "new": 1000, None: 1000}


def dense(x, y):
    """Least squares and HC3 errors by a dense solve."""
    inverse = np.linalg.pinv(x)
    beta = inverse @ y
    hat = np.einsum("ij,ji->i", x, inverse)
    e = (y - x @ beta) / (1 - hat)
    return beta, np.sqrt(np.einsum("ij,j->i", inverse**2, e**2))


def test_least_squares_keep_their_digits(spark):
    """A year, an age and its square, and positions: nearly dependent columns agree with a dense solve in scaled columns."""
    rng = np.random.default_rng(4)
    n, places = 4000, ["Back", "Front", "Keeper", "Middle"]
    age, year, at = rng.uniform(17, 38, n), 2000 + rng.integers(0, 24, n).astype(float), rng.integers(0, 4, n)
    y = 0.2 * age - 0.004 * age**2 + 0.01 * (year - 2000) + np.array([0, 0.3, -0.2, 0.1])[at] + rng.normal(0, 0.1 + 0.01 * age, n)
    data = [(float(a), float(a * a), float(b), places[k], float(v)) for a, b, k, v in zip(age, year, at, y, strict=True)]
    data += [(None, 1.0, 1.0, "Back", 1.0), (20.0, 400.0, 2000.0, None, 1.0)]
    rows = spark.createDataFrame(data, "age double, age_squared double, year double, place string, y double").repartition(9)
    got = {r.term: r for r in regression.ols_robust(rows, "y", ["age", "age_squared", "year"], "place").collect()}
    assert list(got) == ["intercept", "age", "age_squared", "year", "position_Front", "position_Keeper", "position_Middle"]
    x = np.column_stack([np.ones(n), age - 27, (age - 27) ** 2, year - 2012, *((at == k).astype(float) for k in (1, 2, 3))])
    beta, error = dense(x, y)
    assert [got[t].coefficient for t in ("age_squared", "year", "position_Front", "position_Keeper", "position_Middle")] == pytest.approx(list(beta[2:]), rel=1e-8)
    assert [got[t].std_error for t in ("age_squared", "year", "position_Front", "position_Keeper", "position_Middle")] == pytest.approx(list(error[2:]), rel=1e-8)
    assert got["age"].coefficient == pytest.approx(beta[1] - 54 * beta[2], rel=1e-7)


def test_least_squares_with_few_and_dependent_rows(spark):
    rows = spark.createDataFrame([(float(i), 2.0 * i, "a", 3.0 * i + 1) for i in range(5)], "x double, twice double, p string, y double")
    fitted = regression.ols_robust(rows, "y", ["x", "twice"], "p")
    got = [r.yhat for r in regression.predicted(rows, fitted, "yhat", "p").orderBy("x").collect()]
    assert got == pytest.approx([3.0 * i + 1 for i in range(5)])
    with pytest.raises(ValueError, match="complete"):
        regression.ols_robust(rows.limit(0), "y", ["x"])


def features(spark, rng, n_players, shift):
    """Valuations whose change is half of the form above six; forms of later years drift by ``shift``."""
    rows = []
    for p in range(n_players):
        for k in range(10):
            form = float(rng.normal(6 + (shift if k >= 7 else 0), 1))
            change = 0.5 * (form - 6) + float(rng.normal(0, 0.05))
            rows.append((p, dt.date(2015 + k, 1, 1 + p % 28), ("Back", "Front")[p % 2], change, 0.0, 1000.0, 20.0 + k, form))
    schema = "player_id long, valuation_date date, latest_position string, log_value_change double, previous_log_change double, previous_value double, age_at_valuation double, decayed_rating double"
    return spark.createDataFrame(rows, schema)


def test_estimates_of_a_predictor_that_drifts(spark, tmp_path):
    table = features(spark, np.random.default_rng(2), 60, 5.0)
    predictors = ("age_at_valuation", "decayed_rating")
    model, scored, metrics, _ = chain.train(table, predictors, 0.3)
    now = table.where("valuation_date >= '2024-01-01'")
    true = now.agg(F.avg("log_value_change")).first()[0]
    before = {r.player_id: (r.estimate, r.probability_rise) for r in chain.estimates(now, model).collect()}
    mean = np.mean([math.log(v / 1000.0) for v, _ in before.values()])
    assert true > 2 and mean == pytest.approx(true, rel=0.05)
    loaded = models.ValuationModel.load(spark, model.save(f"file://{tmp_path}/model"))
    assert {r.player_id: (r.estimate, r.probability_rise) for r in chain.estimates(now, loaded).collect()} == before
    assert {r.model: r.mae for r in metrics.collect()}["student_t"] < 0.2
    with pytest.raises(Exception, match="no effects of position"):
        chain.estimates(now.withColumn("latest_position", F.lit("Bench")), model).collect()


def test_probability_of_a_rise_leaves_noise_out(spark):
    """A small certain rise is certain, however noisy single changes are."""
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, i % 40, 0.1 + float(rng.standard_t(4)) * 0.3, 0.0) for i in range(8000)], "row_id long, player_id long, y double, x double")
    fit = models.robust_hierarchical_fit(rows, "y", ["x"])
    (r,) = models.posterior_score(spark.createDataFrame([(1, 999, 0.0)], "row_id long, player_id long, x double"), fit, "row_id").collect()
    assert r.lower < 0 < r.median and r.p_increase > 0.99
