"""Model judgement on tables."""

from __future__ import annotations

import numpy as np
import pytest

from tempoframe.operators import evaluation as eva
from tempoframe.plans import modelling


def test_bootstrap_of_the_query_moves_in_steps_of_a_5000th(spark):
    """A close race: the share of samples below zero is a whole number of 5,000ths and of nothing coarser."""
    rows = spark.createDataFrame([(i, 0.0, 1.0 + i * 37 % 101 / 1000, 1.0 + i * 53 % 101 / 1000) for i in range(303)], "row_id long, y double, a double, b double")
    p = eva.bootstrap_difference(rows, "y", "a", "b", key="row_id").first()["p_below_zero"]
    assert 0 < p < 1 and round(p * 5000) == pytest.approx(p * 5000) and any(round(p * n) != pytest.approx(p * n) for n in (200, 500, 1000, 2500))
    assert modelling.bootstrap_difference(spark, "/root/testdata/sf0.001").count() == 1


def test_bootstrap_equals_drawing_rows(spark):
    rng = np.random.default_rng(5)
    y, a, b = rng.normal(0, 1, (3, 400))
    a = a * 0.9
    e = np.abs(a - y) - np.abs(b - y)
    drawn = e[rng.integers(0, 400, (20_000, 400))].mean(axis=1)
    rows = spark.createDataFrame([(i, float(p), float(q), float(r)) for i, (p, q, r) in enumerate(zip(y, a, b, strict=True))], "row_id long, y double, a double, b double")
    one = eva.bootstrap_difference(rows.repartition(3), "y", "a", "b").first()
    other = eva.bootstrap_difference(rows.repartition(1), "y", "a", "b").first()
    sd = drawn.std()
    assert one["mean_difference"] == pytest.approx(e.mean(), abs=0.05 * sd)
    assert (one["lower"], one["upper"]) == (pytest.approx(np.quantile(drawn, 0.025), abs=0.12 * sd), pytest.approx(np.quantile(drawn, 0.975), abs=0.12 * sd))
    assert one["p_below_zero"] == pytest.approx((drawn < 0).mean(), abs=0.03)
    assert round(one["p_below_zero"] * 5000) == pytest.approx(one["p_below_zero"] * 5000)
    assert list(one) == pytest.approx(list(other))


def test_bootstrap_odd_number_of_samples(spark):
    rows = spark.createDataFrame([(i, 0.0, 1.0, 0.0) for i in range(50)], "row_id long, y double, a double, b double")
    assert list(eva.bootstrap_difference(rows, "y", "a", "b", 7).first()) == [1.0, 1.0, 1.0, 0.0]


def test_equal_rows_are_drawn_apart_by_their_key(spark):
    """A hundred equal rows and one other: by key the sample means vary as little as those of drawn rows."""
    rng = np.random.default_rng(8)
    rows = spark.createDataFrame([(i, 0.0, 1.0 + (i % 2), 0.0) for i in range(200)], "row_id long, y double, a double, b double")
    apart = eva.bootstrap_difference(rows, "y", "a", "b", key="row_id").first()
    together = eva.bootstrap_difference(rows.drop("row_id"), "y", "a", "b").first()
    drawn = (1.0 + rng.integers(0, 2, (5000, 200))).mean(axis=1)
    assert apart["upper"] - apart["lower"] == pytest.approx(np.quantile(drawn, 0.975) - np.quantile(drawn, 0.025), rel=0.15)
    assert together["upper"] - together["lower"] > 3 * (apart["upper"] - apart["lower"])


def test_constant_predictions_have_no_rank_correlation(spark):
    rows = spark.createDataFrame([(float(i), 2.0, 1.0) for i in range(9)], "y double, p double, z double")
    assert eva.regression_metrics(rows, "y", "p").first()["spearman"] is None
    assert eva.regression_metrics(rows, "z", "y").first()["r2"] is None
