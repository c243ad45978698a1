"""Fitted models against planted effects."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoframe.operators import evaluation as eva
from tempoframe.operators import models as mod

LEVELS = ["back", "middle", "front"]
INTERCEPT, AGE, FORM = np.array([0.3, 0.0, -0.3]), np.array([-0.2, 0.0, 0.2]), np.array([0.15, 0.0, -0.15])


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n, players = 6000, 150
    who, at = rng.integers(0, players, n), rng.integers(0, 3, n)
    age, form, own = rng.normal(0, 1, n), rng.normal(0, 1, n), rng.normal(0, 0.2, players)
    y = 0.1 + 0.3 * age - 0.2 * form + INTERCEPT[at] + AGE[at] * age + FORM[at] * form + own[who] + 0.1 * rng.standard_t(3, n)
    data = [(i, int(p), LEVELS[a], float(g), float(f), float(v)) for i, (p, a, g, f, v) in enumerate(zip(who, at, age, form, y, strict=True))]
    return spark.createDataFrame(data, "row_id long, player_id long, place string, age double, form double, y double").repartition(4).cache()


@pytest.fixture(scope="module")
def fit(rows):
    return mod.robust_hierarchical_fit(rows, "y", ["age", "form"], position="place", age="age", form="form")


def test_rounds_are_saved(rows, fit):
    """Accelerated rounds end at the mode of plain ones, and there are fewer of them."""
    plain = mod.robust_hierarchical_fit(rows, "y", ["age", "form"], position="place", age="age", form="form", memory=0)
    assert fit.rounds < 0.75 * plain.rounds
    assert fit.beta == pytest.approx(plain.beta, abs=2e-3) and fit.sigma == pytest.approx(plain.sigma, rel=2e-3)


def test_planted_effects_of_positions(fit):
    found = {r["effect"]: r["mean"] for r in mod.effect_summary(fit).where("kind <> 'player'").collect()}
    for base, effect, planted in (("intercept", "intercept", 0.1 + INTERCEPT), ("age", "age_slope", 0.3 + AGE), ("form", "form_slope", -0.2 + FORM)):
        got = [found[base] + found[f"{level}: {effect}"] for level in LEVELS]
        assert got == pytest.approx(list(planted), abs=0.05)


def test_planted_noise(fit):
    assert fit.converged
    assert fit.nu == pytest.approx(3, abs=0.6) and fit.sigma == pytest.approx(0.1, rel=0.1) and fit.scales["player"] == pytest.approx(0.2, rel=0.2)


def test_scores_cover_and_refuse_unknown_positions(rows, fit):
    scored = mod.posterior_score(rows, fit, "row_id").join(rows.withColumnRenamed("row_id", "row_key"), "row_key")
    share = scored.agg(F.avg(F.col("y").between(F.col("lower"), F.col("upper")).cast("double"))).first()[0]
    assert share == pytest.approx(0.9, abs=0.03)
    with pytest.raises(Exception, match="no effects of position"):
        mod.posterior_score(rows.limit(2).withColumn("place", F.lit("bench")), fit, "row_id").collect()


def test_unfinished_fits_raise_or_fail_the_gate(spark, rows):
    with pytest.raises(RuntimeError, match="convergence"):
        mod.robust_hierarchical_fit(rows, "y", ["age"], rounds=1)
    unfinished = mod.robust_hierarchical_fit(rows, "y", ["age"], rounds=1, must_converge=False)
    good = spark.createDataFrame([(0.1, 0.2, 0.6, 0.3, 0.15, 0.4, 0.9)], "mae double, zero_mae double, direction_accuracy double, zero_direction double, ols_mae double, r2 double, coverage double")
    for converged, promoted in ((unfinished.converged, False), (True, True)):
        gate = {r["check"]: r for r in eva.promotion_gate(good.withColumn("converged", F.lit(converged))).collect()}
        assert gate["em_converged"]["passed"] is promoted and gate["em_converged"]["promoted"] is promoted


def test_shot_models_on_held_out_matches(spark, tmp_path):
    """A planted goal probability is found again on matches that the model has not seen, by the model as stored."""
    from tempoframe.plans import features as fea

    shots = fea._shots(spark, "/root/testdata/sf0.01").withColumn("is_own_goal", F.lit(0))
    drawn = F.pmod(F.xxhash64("match_id", "event_id"), F.lit(1_000_000)) / 1_000_000
    planted = shots.withColumn("is_goal", (drawn < 1 / (1 + F.exp((F.col("distance_to_goal") - 25) / 8))).cast("long"))
    apart = mod.held_out(F.col("match_id"), 0.3)
    path = mod.save_model(f"file://{tmp_path}", *mod.fit_xg(planted.where(~apart)))
    scored = mod.score_xg(planted, *mod.load_model(spark, path, "pipeline", "table"))
    unseen = scored.join(planted.where(apart).select("match_id", "event_id", "is_goal", "situation"), ["match_id", "event_id"]).where("situation <> 'Penalty'")
    (m,) = mod.probability_metrics(unseen, "is_goal", "xg").collect()
    assert m.n > 100 and m.log_loss < 0.8 * m.base_log_loss and m.mean_probability == pytest.approx(m.base_rate, abs=0.08)


def test_pass_models_read_every_input(spark):
    from tempoframe.operators import passes as pas

    assert {"x", "y", "end_x", "end_y", "pass_length", "pass_angle", *(c for c in pas.PASS_FLAGS if c in ("is_cross", "is_corner", "is_throw_in"))} <= set(pas.NUMERIC) and len(pas.NUMERIC) == 45


def test_aimed_shot_model_on_held_out_matches(spark, tmp_path):
    """Shots far from the middle of the goal go in, as planted; the stored model finds it on matches that it has not seen."""
    from tempoframe.plans import features as fea

    shots = fea._shots(spark, "/root/testdata/sf0.01")
    drawn = F.pmod(F.xxhash64("match_id", "event_id", F.lit(1)), F.lit(1_000_000)) / 1_000_000
    middle = shots.where(mod.sho.xgot_scope(shots)).agg(F.percentile("goal_mouth_y", 0.5)).first()[0]
    wide = F.abs(F.col("goal_mouth_y") - middle)
    half = shots.where(mod.sho.xgot_scope(shots)).agg(F.percentile(wide, 0.5)).first()[0]
    planted = shots.withColumn("is_goal", (drawn < F.when(wide > half, 0.85).otherwise(0.15)).cast("long"))
    apart = mod.held_out(F.col("match_id"), 0.3)
    path = mod.save_model(f"file://{tmp_path}", *mod.fit_xgot(planted.where(~apart)))
    scored = mod.score_xgot(planted, *mod.load_model(spark, path, "pipeline", "table"))
    unseen = scored.join(planted.where(apart).select("match_id", "event_id", "is_goal"), ["match_id", "event_id"])
    (m,) = mod.probability_metrics(unseen, "is_goal", "xgot").collect()
    assert m.n > 50 and m.log_loss < 0.85 * m.base_log_loss and m.mean_probability == pytest.approx(m.base_rate, abs=0.1)


def test_pass_models_on_held_out_matches(spark, tmp_path):
    """Passes that end near the goal lead to shots worth more, as planted; the stored models find it on matches that they have not seen."""
    from tempoframe.operators import passes as pas
    from tempoframe.plans import features as fea

    rows = mod.xa_frame(fea._passes(spark, "/root/testdata/sf0.01"), pas.xa_targets(fea._shots(spark, "/root/testdata/sf0.01")))
    drawn = F.pmod(F.xxhash64("match_id", "event_id", F.lit(2)), F.lit(1_000_000)) / 1_000_000
    near = F.col("end_x") > 60
    chance, worth = F.when(near, 0.6).otherwise(0.05), F.when(near, 0.4).otherwise(0.1)
    label = (drawn < chance).cast("double")
    planted = rows.withColumns({"label": label, "value": label * worth, "expected": chance * worth})
    apart = mod.held_out(F.col("match_id"), 0.3)
    path = mod.save_model(f"file://{tmp_path}", *mod.fit_xa(planted.where(~apart)))
    scored = mod.score_xa(planted.where(apart), mod.load_model(spark, path, "pipeline", "pipeline"))
    joined = scored.join(planted.select("match_id", "event_id", "expected"), ["match_id", "event_id"])
    by = {round(r.expected, 3): r.m for r in joined.groupBy("expected").agg(F.avg("xa_model").alias("m")).collect()}
    assert by[0.24] == pytest.approx(0.24, abs=0.05) and by[0.005] < 0.04


def test_a_fit_of_passes_makes_its_rows_once(spark):
    """Both models and their indexers read what was written, however many passes they take."""
    from tempoframe.operators import passes as pas
    from tempoframe.plans import features as fea

    rows = mod.xa_frame(fea._passes(spark, "/root/testdata/sf0.001"), pas.xa_targets(fea._shots(spark, "/root/testdata/sf0.001")))
    made = spark.sparkContext.accumulator(0)

    def counted(k):
        made.add(1)
        return float(k % 2)

    mod.fit_xa(rows.withColumn("label", F.udf(counted, "double")("event_id")), rounds=1)
    assert made.value == rows.count()
