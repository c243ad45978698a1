"""The whole chain from rated matches and valuations to a judged model, current estimates and a serving table, with a record of the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoframe.functions.state import written
from tempoframe.operators import evaluation as eva
from tempoframe.operators import models as mod
from tempoframe.operators import valuation as val
from tempoframe.operators.entities import collect_entities, match_entities, review_queue
from tempoframe.operators.form import form_history
from tempoframe.operators.journal import Journal
from tempoframe.operators.preparation import fit_preparation
from tempoframe.operators.regression import ols_robust, predicted
from tempoframe.operators.ratings import rate_matches
from tempoframe.operators.serving import latest_per_key, match_impacts, merge_upsert

#: What the regression reads of a feature row; positions have slopes on the third and the last.
PREDICTORS = ("log_previous_value", "previous_log_change", "age_at_valuation", "age_squared", "log_minutes", "start_share", "rating_trend", "asof_form", "decayed_rating")
_KEYS = ("player_id", "valuation_date")


def _keyed(features: DataFrame) -> DataFrame:
    """Feature rows with a number, from player and date, and a position that is never null."""
    return features.withColumns({"row_id": F.abs(F.xxhash64(*_KEYS)), "place": F.coalesce("latest_position", F.lit("Unknown"))})


def _scored(rows: DataFrame, model: mod.ValuationModel) -> DataFrame:
    return rows.join(model.score(rows, "row_id").withColumnRenamed("row_key", "row_id"), "row_id")


def train(features: DataFrame, predictors: tuple[str, ...] = PREDICTORS, test_share: float = 0.2) -> tuple[mod.ValuationModel, DataFrame, DataFrame, DataFrame]:
    """Fits on the earlier valuations and judges on the later ones.

    Returns the model (a fit with the preparation of its rows), its scores of the later rows, metrics of it, of least squares and of both baselines (one row a model), and
    the checks of the gate. Predictors are filled and scaled by the earlier rows alone; positions are those of all rows.
    """
    names = list(predictors)
    rows = written(eva.baseline_predictions(eva.chronological_split(_keyed(features), "valuation_date", test_share)), "split")
    learned, later = rows.where("part = 'train'"), rows.where("part = 'test'")
    ready = fit_preparation(learned, names, "place", rows)
    learned = written(ready.apply(learned), "prepared")
    fit = mod.robust_hierarchical_fit(
        learned, "log_value_change", names, position="place", age="age_at_valuation", form="decayed_rating", levels=ready.levels, must_converge=False
    )
    model = mod.ValuationModel(ready, fit)
    line = ols_robust(learned, "log_value_change", names, "place", ready.levels)
    ols = predicted(ready.apply(later), line, "ols", "place").select("row_id", "ols")
    scored = written(_scored(later, model).join(ols, "row_id"), "scored")
    models = {"student_t": "median", "ols": "ols", "zero_change": "zero_change", "previous_change": "previous_change"}
    parts = [eva.regression_metrics(scored, "log_value_change", c).withColumn("model", F.lit(name)) for name, c in models.items()]
    metrics = written(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "metrics")
    by = {r["model"]: r for r in metrics.collect()}
    cover = eva.interval_coverage(scored, "log_value_change", "lower", "upper")
    candidate = metrics.where("model = 'student_t'").withColumns({
        "zero_mae": F.lit(by["zero_change"]["mae"]), "zero_direction": F.lit(by["zero_change"]["direction_accuracy"]), "ols_mae": F.lit(by["ols"]["mae"]), "converged": F.lit(fit.converged),
    })
    return model, scored, metrics, written(eva.promotion_gate(candidate.crossJoin(cover)), "gate")  # one row each


def estimates(current: DataFrame, model: mod.ValuationModel) -> DataFrame:
    """Estimated values of ``current`` rows with 90 % limits, prepared as the rows that the model was fitted on; a position that it does not know raises an error."""
    scored = _scored(_keyed(current), model)
    value = lambda c: F.col("previous_value") * F.exp(c)
    return scored.select(
        *_KEYS, "previous_value", value("median").alias("estimate"), value("lower").alias("estimate_lower"), value("upper").alias("estimate_upper"),
        F.expm1("median").alias("predicted_pct_change"), F.col("p_increase").alias("probability_rise"),
    )


def run(
    valuations: DataFrame, ratings: DataFrame, as_of: str, path: str, previous: DataFrame | None = None, candidates: DataFrame | None = None, overrides: DataFrame | None = None
) -> DataFrame:
    """Runs all stages with a journal below ``path``: rated, (mapping, review), form, intervals, features, metrics, effects, gate, current, estimates, players.

    ``ratings`` are rated rows, or player-match rows that are rated first. With ``candidates`` (``candidate_id``, ``name_key``) valuations are those of candidates, which are
    mapped to players by approved ``overrides`` and unique names; the rest is in the review stage. Estimates are made only by a model that the gate promotes; otherwise their
    stage is 'skipped_not_promoted'. ``players`` is the latest rating and form of each player with the estimate, upserted into ``previous`` if that is given.

    Returns the last record of each stage. A stage whose inputs were seen before is read again, not made; a stage that fails leaves a record 'failed', and so
    does the run, and the next run starts there. ``Journal(spark, path).latest(stage)`` reads a stage's table.
    """
    journal = Journal(ratings.sparkSession, path)
    return journal.whole(lambda j: _stages(j, valuations, ratings, as_of, previous, candidates, overrides))


def _stages(journal: Journal, valuations: DataFrame, ratings: DataFrame, as_of: str, previous: DataFrame | None, candidates: DataFrame | None, overrides: DataFrame | None) -> None:
    spark, stage = journal.spark, journal.stage
    for name, df in (("ratings", ratings), ("valuations", valuations), ("previous", previous), ("candidates", candidates), ("overrides", overrides)):
        journal.input(name, df)
    rate = "rating" not in ratings.columns
    rated = stage("rated", ["ratings"], lambda _: val.ratings_prepare(rate_matches(ratings).withColumnRenamed("post_match_rating", "rating") if rate else ratings))
    worth, of = valuations, "valuations"
    if candidates is not None:
        none = spark.createDataFrame([], "player_id long, candidate_id long")
        names = collect_entities(rated.withColumns({c: F.lit(None).cast("long") for c in ("team_id", "position") if c not in rated.columns}))
        mapping = stage("mapping", ["rated", "candidates", "overrides"], lambda _: match_entities(names, candidates, none if overrides is None else overrides))
        stage("review", ["rated", "candidates", "mapping"], lambda _: review_queue(names, candidates, mapping))
        worth, of = valuations.join(mapping.select("player_id", "candidate_id"), "candidate_id").drop("candidate_id"), "mapping"
    form = stage("form", ["rated"], lambda _: form_history(rated).select("player_id", "match_id", "match_date", "rating", "form_rating_ewm"))
    intervals = stage("intervals", ["valuations", of, "rated"], lambda _: val.valuation_intervals(val.valuation_clean(worth), rated))
    features = stage("features", ["intervals", "rated"], lambda _: val.valuation_feature_table(intervals, rated))

    def trained(place: str) -> DataFrame:
        model, _, metrics, gate = train(features)
        model.save(f"{place}-model")
        gate.write.mode("overwrite").parquet(f"{place}-gate")
        return metrics

    stage("metrics", ["features"], trained)
    place = journal.place("metrics")
    model = mod.ValuationModel.load(spark, f"{place}-model")
    stage("effects", ["metrics"], lambda _: mod.effect_summary(model.fit))
    promoted = stage("gate", ["metrics"], lambda _: spark.read.parquet(f"{place}-gate")).first()["promoted"]
    now = stage("current", ["valuations", of, "rated"], lambda _: val.current_asof_features(val.valuation_clean(worth), rated, as_of), as_of)
    made = estimates(now, model)
    valued = stage("estimates", ["current", "gate"], lambda _: made if promoted else made.limit(0), None, "succeeded" if promoted else "skipped_not_promoted")
    players = latest_per_key(form, ["player_id"], ["match_date", "match_id"]).join(valued.select("player_id", "estimate", "estimate_lower", "estimate_upper"), "player_id", "left")
    stage("players", ["form", "estimates", "previous"], lambda _: players if previous is None else merge_upsert(previous, players, ["player_id"]))


def materialize(features: DataFrame, path: str, previous: DataFrame | None = None) -> DataFrame:
    """The serving table of players from player-match rows with ``match_date``: rated, with form, the latest row of each player, upserted into the previous table.

    The stages are kept in a journal below ``path``, as those of ``run``.
    """
    journal = Journal(features.sparkSession, path)

    def work(j: Journal) -> None:
        j.input("player_rows", features)
        j.input("previous", previous)
        rated = j.stage("rated", ["player_rows"], lambda _: rate_matches(features).select("player_id", "match_id", "match_date", "minutes", F.col("post_match_rating").alias("rating")))
        form = j.stage("form", ["rated"], lambda _: form_history(rated))
        latest = match_impacts(latest_per_key(form, ["player_id"], ["match_date", "match_id"]))
        served = latest.select("player_id", "match_id", "rating", "form_rating_ewm", "impact", "impact_label")
        j.stage("players", ["form", "previous"], lambda _: served if previous is None else merge_upsert(previous, served, ["player_id"]))

    journal.whole(work)
    return journal.latest("players")
