"""Queries that fit models; SQL cannot express them, tests judge them by held-out and planted values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.state import shared_path
from tempoframe.operators import models as mod
from tempoframe.operators import passes as pas
from tempoframe.operators.preparation import fit_preparation
from tempoframe.plans import features as fea
from tempoframe.plans.fixtures import on_tables
from tempoframe.plans.modelling import MODEL_ROWS


def _stored(spark: SparkSession, name: str, *parts):
    """The parts of a fit as they come back from the shared folder."""
    kinds = ["table" if isinstance(p, DataFrame) else "pipeline" for p in parts]
    return mod.load_model(spark, mod.save_model(shared_path(spark, name), *parts), *kinds)


def _taught(rows: DataFrame) -> DataFrame:
    """The matches that models are fitted on; a fifth is held out."""
    return rows.where(~mod.held_out(F.col("match_id")))


def xg_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """xG of all shots by a model fitted on four fifths of the matches, stored and read back."""
    shots = fea._shots(spark, sf_dir)
    scored = mod.score_xg(shots, *_stored(spark, "xg", *mod.fit_xg(_taught(shots))))
    return scored.withColumn("held_out", mod.held_out(F.col("match_id")))


def xgot_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """xGOT of all aimed shots, likewise."""
    shots = fea._shots(spark, sf_dir)
    scored = mod.score_xgot(shots, *_stored(spark, "xgot", *mod.fit_xgot(_taught(shots))))
    return scored.withColumn("held_out", mod.held_out(F.col("match_id")))


def xa_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """xA of all completed passes, likewise."""
    rows = mod.xa_frame(fea._passes(spark, sf_dir), pas.xa_targets(fea._shots(spark, sf_dir)))
    scored = mod.score_xa(rows, _stored(spark, "xa", *mod.fit_xa(_taught(rows))))
    return scored.withColumn("held_out", mod.held_out(F.col("match_id")))


def _fit(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, mod.RobustFit]:
    rows = on_tables(spark, sf_dir, f"WITH {MODEL_ROWS} SELECT s.*, o_custkey AS player_id FROM scored s JOIN orders ON o_orderkey = row_id")
    return rows, mod.robust_hierarchical_fit(rows, "actual", ["predicted", "a1"], position="level", age="a1", form="predicted")


def robust_hierarchical_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the robust fit, its noise, and whether it converged."""
    fit = _fit(spark, sf_dir)[1]
    return mod.effect_summary(fit).where("kind = 'coefficient'").withColumns({"sigma": F.lit(fit.sigma), "nu": F.lit(fit.nu), "converged": F.lit(fit.converged)})


def effect_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All effects of the robust fit."""
    return mod.effect_summary(_fit(spark, sf_dir)[1])


def posterior_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted changes of all rows by a model fitted on those before 1997: predictors go through the preparation of that fit, both stored and read back."""
    rows = on_tables(spark, sf_dir, f"WITH {MODEL_ROWS} SELECT s.*, o_custkey AS player_id FROM scored s JOIN orders ON o_orderkey = row_id")
    learned = rows.where("day < '1997-01-01'")
    ready = fit_preparation(learned, ["predicted", "a1", "a2"], "level", rows)
    fit = mod.robust_hierarchical_fit(ready.apply(learned), "actual", ["predicted", "a1", "a2"], position="level", age="a1", form="predicted", levels=ready.levels)
    model = mod.ValuationModel(ready, fit)
    return mod.ValuationModel.load(spark, model.save(shared_path(spark, "valuation-model"))).score(rows, "row_id")


QUERIES = (xg_model, xgot_model, xa_model, robust_hierarchical_fit, effect_summary, posterior_score)
ORACLES: dict[str, str] = {}
