"""Fitted models: shot and pass values by boosted trees, and a robust hierarchical regression."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import clip
from tempoframe.functions.state import written
from tempoframe.operators import passes as pas
from tempoframe.operators import shots as sho
from tempoframe.operators.preparation import Preparation

SHOT_NUMERIC = ("distance_to_goal", "angle_to_goal", "x", *sho.BASE[0], *sho.BASE[1])
SHOT_CATEGORIES = ("body_part_clean", "situation_clean", "shot_location_name_clean", *sho.BUCKETS[0])
XGOT_NUMERIC = tuple(c for layer in (*sho.PLACEMENT, *sho.TRAJECTORY) for c in layer)


def _assembled(numeric: tuple[str, ...], categories: tuple[str, ...]) -> list:
    steps = StringIndexer(inputCols=list(categories), outputCols=[f"{c}_index" for c in categories], handleInvalid="keep")  # all in one pass
    return [steps, VectorAssembler(inputCols=[*numeric, *(f"{c}_index" for c in categories)], outputCol="model_features", handleInvalid="keep")]


def _trees(kind, label: str, rounds: int, seed: int):
    return kind(featuresCol="model_features", labelCol=label, predictionCol=f"{label}_prediction", maxIter=rounds, maxDepth=4, maxBins=64, stepSize=0.1, seed=seed)


def shot_frame(shots: DataFrame) -> DataFrame:
    """Shots with base features and buckets, numbers as doubles."""
    made = sho.bucketize_shots(sho.xg_base_features(shots))
    return made.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SHOT_NUMERIC}).withColumn("label", (F.col("is_goal") == 1).cast("double"))


#: Features with long tails, held within quantiles of the shots that a model is fitted on.
CLIPPED = ("inverse_distance", "distance_angle_ratio", "central_close")


def fit_xg(shots: DataFrame, rounds: int = 20, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Goal probability of shots in scope, and the bounds (one row) within which long-tailed features were held."""
    rows = shot_frame(shots.where(sho.xg_scope(shots)))
    bounds = written(sho.quantile_bounds(rows, list(CLIPPED)), "bounds")
    held = sho.clip_to(rows, bounds, list(CLIPPED))
    return Pipeline(stages=[*_assembled(SHOT_NUMERIC, SHOT_CATEGORIES), _trees(GBTClassifier, "label", rounds, seed)]).fit(held), bounds


def score_xg(shots: DataFrame, model: PipelineModel, bounds: DataFrame) -> DataFrame:
    """``xg`` of each shot: zero for own goals, a fixed probability for penalties, the model's otherwise; null coordinates have none."""
    scored = model.transform(sho.clip_to(shot_frame(shots), bounds, list(CLIPPED)))
    p = vector_to_array("probability")[1]
    xg = F.when(F.coalesce(F.col("is_own_goal"), F.lit(0)) == 1, sho.OWN_GOAL_XG).when(F.coalesce("is_penalty_situation", F.lit(False)), sho.PENALTY_XG).when(F.col("x").isNotNull() & F.col("y").isNotNull(), p)
    return scored.select("match_id", "event_id", xg.alias("xg"))


def save_model(path: str, *parts: PipelineModel | DataFrame) -> str:
    """Writes the parts of a fit, fitted pipelines and tables, to folders of ``path``."""
    for k, part in enumerate(parts):
        writer = part.write.mode("overwrite") if isinstance(part, DataFrame) else part.write().overwrite()
        (writer.parquet if isinstance(part, DataFrame) else writer.save)(f"{path}/{'table' if isinstance(part, DataFrame) else 'pipeline'}-{k}")
    return path


def load_model(spark: SparkSession, path: str, *kinds: str) -> tuple[PipelineModel | DataFrame, ...]:
    """The parts of a fit as ``save_model`` wrote them; ``kinds`` names each as 'pipeline' or 'table'."""
    return tuple(spark.read.parquet(f"{path}/table-{k}") if kind == "table" else PipelineModel.load(f"{path}/pipeline-{k}") for k, kind in enumerate(kinds))


def held_out(keys: Column, share: float = 0.2) -> Column:
    """Whether a row is kept out of a fit, by the hash of its keys: whole matches stay together where the match is the key."""
    return F.pmod(F.xxhash64(keys), F.lit(1000)) < int(share * 1000)


def probability_metrics(rows: DataFrame, label: str, probability: str) -> DataFrame:
    """One row: rows, share of the label, mean probability, Brier score, log loss, and the log loss of always saying the share."""
    y, p = F.col(label).cast("double"), F.least(F.greatest(F.col(probability), F.lit(1e-9)), F.lit(1 - 1e-9))
    got = rows.where(F.col(probability).isNotNull() & F.col(label).isNotNull()).agg(
        F.count("*").alias("n"), F.avg(y).alias("base_rate"), F.avg(p).alias("mean_probability"), F.avg((p - y) * (p - y)).alias("brier"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
    )
    b = F.least(F.greatest(F.col("base_rate"), F.lit(1e-9)), F.lit(1 - 1e-9))
    return got.withColumn("base_log_loss", -(b * F.log(b) + (1 - b) * F.log(1 - b)))


def fit_xgot(shots: DataFrame, rounds: int = 20, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Goal probability of aimed shots (column ``xg`` known) and the goal frame that it was fitted in."""
    scope = shots.where(sho.xgot_scope(shots))
    frame = written(sho.goal_frame_params(scope), "goal-frame")
    return Pipeline(stages=[*_assembled(("xg", *XGOT_NUMERIC), ("body_part", "situation")), _trees(GBTClassifier, "label", rounds, seed)]).fit(_aimed(scope, frame)), frame


def _aimed(scope: DataFrame, frame: DataFrame) -> DataFrame:
    made = sho.xgot_trajectory_features(sho.xgot_placement_features(scope, frame))
    return made.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("xg", *XGOT_NUMERIC)}).withColumn("label", (F.col("is_goal") == 1).cast("double"))


def score_xgot(shots: DataFrame, model: PipelineModel, frame: DataFrame) -> DataFrame:
    """``xgot`` of aimed shots; others have no row."""
    return model.transform(_aimed(shots.where(sho.xgot_scope(shots)), frame)).select("match_id", "event_id", vector_to_array("probability")[1].alias("xgot"))


def xa_frame(passes: DataFrame, targets: DataFrame) -> DataFrame:
    """Completed passes with geometry and what they led to; nothing is zero."""
    done = passes.where(F.col("success") == 1).dropna(subset=["x", "y", "end_x", "end_y"])
    rows = pas.pass_geometry_features(done).join(targets, ["match_id", "team_id", "event_id"], "left").fillna(0, ["shot_created", "xa_target"])
    return rows.withColumns({c: F.col(c).cast("double") for c in pas.NUMERIC}).withColumns({"label": F.col("shot_created").cast("double"), "value": F.col("xa_target").cast("double")})


def fit_xa(rows: DataFrame, rounds: int = 10, seed: int = 42) -> tuple[PipelineModel, PipelineModel]:
    """Probability that a pass makes a shot, and the xG of the shot if it does."""
    rows = written(rows.select(*pas.NUMERIC, *pas.CATEGORIES, "label", "value"), "xa-rows")  # a fit reads its rows many times
    shape = _assembled(pas.NUMERIC, pas.CATEGORIES)
    made = Pipeline(stages=[*shape, _trees(GBTClassifier, "label", rounds, seed)]).fit(rows)
    worth = Pipeline(stages=[*shape, _trees(GBTRegressor, "value", rounds, seed)]).fit(rows.where("label = 1"))
    return made, worth


def score_xa(rows: DataFrame, models: tuple[PipelineModel, PipelineModel], calibration: float = 1.0) -> DataFrame:
    """``xa_model`` of completed passes: probability of a shot times its clipped value, calibrated and clipped."""
    keep = ["match_id", "event_id", "player_id"]
    first = models[0].transform(rows).select(*rows.columns, vector_to_array("probability")[1].alias("p_shot_created"))
    both = models[1].transform(first).select(*keep, "p_shot_created", clip(F.col("value_prediction"), 0, 1).alias("conditional_shot_xg"))
    return both.withColumn("xa_model", clip(F.col("p_shot_created") * F.col("conditional_shot_xg") * calibration, 0, 1))


#: Scales of the half-normal priors: spread of coefficients, position intercepts, age slopes, form slopes, player intercepts and noise.
SCALE_PRIORS = {"beta": 0.30, "position": 0.25, "age": 0.15, "form": 0.15, "player": 0.20, "sigma": 0.40}
#: Prior deviation of the intercept, and rate of the exponential prior of nu - 2.
INTERCEPT_SD, NU_RATE = 0.5, 0.10
_NUS = 2 + np.geomspace(0.02, 200, 40)


@dataclass(frozen=True)
class RobustFit:
    """Mode and curvature of a Student-t regression with shrunken effects of positions and players.

    ``terms`` names the entries of ``beta`` as (kind, position, effect). ``players`` holds of each player the intercept ``u``, its variance ``v``, the part ``c``
    of it that remains when beta is known, and ``h``, by which it falls as beta rises.
    """

    predictors: tuple[str, ...]
    terms: tuple[tuple[str, str | None, str], ...]
    levels: tuple[str, ...]
    position: str | None
    slopes: tuple[str, ...]
    beta: np.ndarray
    covariance: np.ndarray
    sigma: float
    scales: dict[str, float]
    nu: float
    converged: bool
    rounds: int
    players: DataFrame


def save_fit(path: str, fit: RobustFit) -> str:
    """Writes a fit to folders of ``path``: its numbers as a line of JSON, effects of players as a table."""
    plain = {f.name: getattr(fit, f.name) for f in fields(fit) if f.name != "players"}
    text = json.dumps(plain | {"beta": fit.beta.tolist(), "covariance": fit.covariance.tolist()})
    fit.players.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/numbers")
    fit.players.write.mode("overwrite").parquet(f"{path}/players")
    return path


def load_fit(spark: SparkSession, path: str) -> RobustFit:
    """A fit as ``save_fit`` wrote it."""
    got = json.loads(spark.read.text(f"{path}/numbers").first()[0])
    got |= {c: np.array(got[c]) for c in ("beta", "covariance")} | {c: tuple(got[c]) for c in ("predictors", "levels", "slopes")}
    return RobustFit(**got | {"terms": tuple(tuple(t) for t in got["terms"]), "players": spark.read.parquet(f"{path}/players")})


@dataclass(frozen=True)
class ValuationModel:
    """A fit with the preparation that its predictors went through: whatever is scored later goes through the same one."""

    preparation: Preparation
    fit: RobustFit

    def score(self, rows: DataFrame, key: str) -> DataFrame:
        """``posterior_score`` of raw rows."""
        return posterior_score(self.preparation.apply(rows), self.fit, key)

    def save(self, path: str) -> str:
        self.preparation.save(self.fit.players.sparkSession, f"{path}/preparation")
        return save_fit(f"{path}/fit", self.fit).removesuffix("/fit")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ValuationModel:
        return ValuationModel(Preparation.load(spark, f"{path}/preparation"), load_fit(spark, f"{path}/fit"))


def _design(batch: pd.DataFrame, predictors: tuple[str, ...], levels: tuple[str, ...], position: str | None, slopes: tuple[str, ...]) -> np.ndarray:
    """Rows of the normal equations: one, predictors, then for each effect of positions one column a level."""
    x = np.column_stack([np.ones(len(batch)), *(batch[c].to_numpy(np.float64) for c in predictors)])
    if position is None:
        return x
    at = pd.Index(levels).get_indexer(batch[position])
    if (at < 0).any():
        raise ValueError(f"no effects of position {sorted(set(batch[position][at < 0].astype(str)))}")
    here = np.eye(len(levels))[at]
    return np.hstack([x, here, *(here * batch[[c]].to_numpy(np.float64) for c in slopes)])


def _scale(n: float, q: float, prior: float) -> float:
    """The scale at which -n log s - q / 2s² - s² / 2 prior² is largest."""
    return math.sqrt(max(2 * q / (n + math.sqrt(n * n + 4 * q / prior**2)), 1e-12)) if q > 0 else 1e-6


def _nu(logs: np.ndarray, n: float) -> float:
    """The largest of the profile of nu, between the places of the grid by a parabola; ``logs`` are sums of log(1 + r² / nu s²)."""
    gamma = np.array([math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - math.log(v) / 2 for v in _NUS])
    f = n * gamma - (_NUS + 1) / 2 * logs - NU_RATE * (_NUS - 2)
    i, t = int(f.argmax()), np.log(_NUS - 2)
    if not 0 < i < len(f) - 1:
        return float(_NUS[i])
    bend = f[i - 1] - 2 * f[i] + f[i + 1]
    return 2 + math.exp(t[i] + (t[1] - t[0]) / 2 * (f[i - 1] - f[i + 1]) / bend) if bend < 0 else float(_NUS[i])


def _summed(rows: DataFrame, task) -> np.ndarray:
    """The sum over all batches of the vectors that ``task`` makes of them; tasks return one each."""

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                total = task(batch) if total is None else total + task(batch)
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "s": total})

    got = rows.mapInPandas(added, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toPandas()
    return got.sort_values("i")["s"].to_numpy()


class _Accelerator:
    """Anderson's mixing of the rounds of a fixed point: the next start is the point whose change, by the last ``memory`` rounds, would be least.

    A round whose change has grown to twice the least so far, or a step far beyond the plain one, drops what is remembered and goes on plainly.
    """

    def __init__(self, memory: int) -> None:
        self.memory, self.changes, self.ends, self.least = memory, [], [], math.inf

    def next(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        change = end - start
        size = float(np.linalg.norm(change))
        if size > 2 * self.least:
            self.changes, self.ends = [], []
        self.least = min(self.least, size)
        self.changes, self.ends = [*self.changes[-self.memory :], change], [*self.ends[-self.memory :], end]
        if self.memory < 1 or len(self.changes) < 2:
            return end
        moves, steps = np.diff(np.array(self.changes), axis=0).T, np.diff(np.array(self.ends), axis=0).T
        ridge = 1e-10 * max(float((moves**2).sum()), 1e-300)
        mix = np.linalg.solve(moves.T @ moves + ridge * np.eye(moves.shape[1]), moves.T @ change)
        step = steps @ mix
        if not np.isfinite(step).all() or np.linalg.norm(step) > 20 * size:
            self.changes, self.ends = self.changes[-1:], self.ends[-1:]
            return end
        return end - step


def robust_hierarchical_fit(
    rows: DataFrame, target: str, predictors: list[str], player: str = "player_id", position: str | None = None, age: str | None = None, form: str | None = None,
    levels: tuple[str, ...] | None = None, memory: int = 5, rounds: int = 200, tolerance: float = 1e-4, must_converge: bool = True,
) -> RobustFit:
    """Student-t regression with intercepts of players and of positions and slopes of positions on ``age`` and ``form`` (two of the predictors), all drawn towards zero.

    Expectation maximisation: rows are weighted by (nu + 1) / (nu + r² / s²), sums by player take the player's intercept out of the normal equations (Schur
    complement), and their totals, whose size is that of the predictors and positions, are solved on the driver. The scales of all effects and of the noise
    have half-normal priors and are moved to where the effects and their degrees of freedom agree; nu - 2 has an exponential prior and is taken from the
    profile of the likelihood. Rounds are accelerated by Anderson's mixing over ``memory`` of them (0: not), on coefficients and on logarithms of scales. ``levels`` may name positions that no row has; their effects are zero with the spread of the others. Rounds end when coefficients, scales and the logarithm of nu move by less than ``tolerance`` (nu: its hundredfold); if they do not, an
    error is raised, or without ``must_converge`` the fit says so. This approximates a sampled posterior by its mode and curvature; rows with nulls are left out.
    """
    slopes = tuple(c for c in (age, form) if c is not None)
    if position is None and slopes or not set(slopes) <= set(predictors):
        raise ValueError("slopes of positions need a position and are on predictors")
    keys = [player] if position is None else [player, position]
    named = [F.col(player).alias("player"), F.col(target).cast("double").alias("y"), *(F.col(c).cast("double").alias(c) for c in predictors)]
    base = written(rows.dropna(subset=[target, *keys, *predictors]).select(*named, *([] if position is None else [F.col(position).cast("string").alias("position")])), "fit-rows")
    if position is None:
        levels = ()
    elif levels is None:
        levels = tuple(sorted(r[0] for r in base.select("position").distinct().collect()))
    shape = (tuple(predictors), levels, None if position is None else "position", slopes)
    kinds = [("position", "intercept"), *((n, f"{n}_slope") for n, c in (("age", age), ("form", form)) if c is not None)] if levels else []
    terms = (("coefficient", None, "intercept"), *(("coefficient", None, c) for c in predictors), *(("position", v, e) for _, e in kinds for v in levels))
    k, q = len(terms), len(predictors)
    groups = {"beta": slice(1, 1 + q)} | {n: slice(1 + q + i * len(levels), 1 + q + (i + 1) * len(levels)) for i, (n, _) in enumerate(kinds)}
    columns = [f"x{j}" for j in range(k)]
    first = base.agg(F.stddev_pop("y").alias("s"), F.count("*").alias("n"), F.percentile("y", 0.5).alias("m")).first()
    n = first["n"]
    if not n:
        raise ValueError("no row is complete")
    sigma, nu, beta = max(first["s"], 1e-6), 5.0, np.zeros(k)
    scales, beta[0] = {g: SCALE_PRIORS[g] / 2 for g in (*groups, "player")}, first["m"]
    players = base.select("player").distinct().withColumn("u", F.lit(0.0))
    mixer, ahead = _Accelerator(memory), None
    n_players = players.count()
    converged, done = False, 0
    while done < rounds and not converged:
        done += 1
        own = F.col("u")
        if ahead is not None:  # intercepts that belong to the coefficients that the round starts from
            own = own - F.aggregate(F.zip_with("h", F.array(*(F.lit(float(v)) for v in ahead)), lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
        known = base.join(players.select("player", own.alias("u")), "player")

        def weighted(batches: Iterator[pd.DataFrame], beta=beta, sigma=sigma, nu=nu) -> Iterator[pd.DataFrame]:
            total = 0.0
            for batch in batches:
                d, y = _design(batch, *shape), batch["y"].to_numpy()
                r2 = (y - batch["u"].to_numpy() - d @ beta) ** 2 / sigma**2
                w, v = (nu + 1) / (nu + r2), np.column_stack([y, d])
                total = total + np.concatenate([(v.T @ (v * w[:, None])).ravel(), *(np.log1p(r2 / x).sum(keepdims=True) for x in _NUS)])
                yield pd.DataFrame({"player": batch["player"], "i": -1, "w": w, "y": y, **dict(zip(columns, d.T, strict=True))})
            if np.ndim(total):  # a task's part of the cross products of all rows, as rows without a player
                yield pd.DataFrame({"player": pd.Series([None] * len(total), dtype=object), "i": np.arange(len(total)), "w": total, "y": 0.0, **dict.fromkeys(columns, 0.0)})

        player_type = base.schema["player"].dataType.simpleString()
        # one pass over the rows gives both the sums of players and those of all rows
        made = known.mapInPandas(weighted, f"player {player_type}, i int, w double, y double, {', '.join(f'{c} double' for c in columns)}")
        sums = written(made.groupBy("player", "i").agg(F.sum("w").alias("w"), *(F.sum(F.col("w") * F.col(c)).alias(c) for c in ("y", *columns))), "player-sums")
        by = sums.where("player is not null").drop("i")

        pull = (sigma / scales["player"]) ** 2

        def taken(batch: pd.DataFrame, pull=pull) -> np.ndarray:
            v, d = batch[["y", *columns]].to_numpy(), batch["w"].to_numpy() + pull
            return (v.T @ (v / d[:, None])).ravel()

        whole, logs = np.split(sums.where("player is null").select("i", "w").toPandas().sort_values("i")["w"].to_numpy(), [(k + 1) ** 2])
        whole, nu_was, nu = whole.reshape(k + 1, k + 1), nu, _nu(logs, n)
        m = whole - _summed(by, taken).reshape(k + 1, k + 1)
        precision = np.full(k, INTERCEPT_SD**-2.0)
        for g, part in groups.items():
            precision[part] = scales[g] ** -2.0
        covariance = np.linalg.inv(m[1:, 1:] / sigma**2 + np.diag(precision))
        new = covariance @ m[1:, 0] / sigma**2

        def solved(batches: Iterator[pd.DataFrame], beta=new, covariance=covariance, sigma=sigma, pull=pull) -> Iterator[pd.DataFrame]:
            for batch in batches:
                d = batch["w"].to_numpy() + pull
                h = batch[columns].to_numpy() / d[:, None]
                c, u = sigma**2 / d, batch["y"].to_numpy() / d - h @ beta
                # what the intercept takes from the sum of w r²
                ur = u * (u * batch["w"].to_numpy() - 2 * u * d)
                yield pd.DataFrame({"player": batch["player"], "u": u, "v": c + ((h @ covariance) * h).sum(axis=1), "c": c, "h": list(h), "ur": ur})

        players = by.mapInPandas(solved, f"player {player_type}, u double, v double, c double, h array<double>, ur double")  # as small a step as reading it
        got = players.agg(F.sum(F.col("u") ** 2).alias("uu"), F.sum("v").alias("vv"), F.sum("ur").alias("ur")).first()
        side = np.concatenate(([1.0], -new))
        rss = max(side @ whole @ side + got["ur"], 1e-12 * n)
        free = {g: max(part.stop - part.start - (np.diag(covariance)[part]).sum() / scales[g] ** 2, 1e-9) for g, part in groups.items()} | {"player": max(n_players - got["vv"] / scales["player"] ** 2, 1e-9)}
        size = {g: float((new[part] ** 2).sum()) for g, part in groups.items()} | {"player": got["uu"]}
        was = np.array([*beta, *scales.values(), sigma])
        begun = np.array([*beta, *np.log([*scales.values(), sigma, max(nu_was - 2, 1e-6)])])
        scales = {g: _scale(free[g], size[g], SCALE_PRIORS[g]) for g in scales}
        sigma = _scale(max(n - sum(free.values()) - 1, 1.0), rss, SCALE_PRIORS["sigma"])
        beta = new
        moved = np.abs(np.array([*beta, *scales.values(), sigma]) - was).max()
        converged = bool(moved < tolerance and abs(math.log(nu / nu_was)) < 100 * tolerance)
        if not converged and done < rounds:
            start = mixer.next(begun, np.array([*beta, *np.log([*scales.values(), sigma, max(nu - 2, 1e-6)])]))
            ahead = start[:k] - beta
            beta, raised = start[:k], np.exp(start[k:])
            scales, sigma, nu = dict(zip(scales, raised, strict=False)), float(raised[-2]), 2 + float(raised[-1])
    if must_converge and not converged:
        raise RuntimeError(f"no convergence within {rounds} rounds")
    return RobustFit(tuple(predictors), terms, levels, position, slopes, beta, covariance, sigma, scales, nu, converged, done, written(players, "player-effects"))


def effect_summary(fit: RobustFit) -> DataFrame:
    """Mean, deviation, 90 % limits and probability above zero of every coefficient, effect of a position and player intercept."""
    spark = fit.players.sparkSession
    named = ((kind, e if level is None else f"{level}: {e}") for kind, level, e in fit.terms)
    terms = [(e, float(b), float(math.sqrt(max(v, 0))), kind) for (kind, e), b, v in zip(named, fit.beta, np.diag(fit.covariance), strict=True)]
    rows = spark.createDataFrame(terms, "effect string, mean double, sd double, kind string")
    rows = rows.unionByName(fit.players.select(F.col("player").cast("string").alias("effect"), F.col("u").alias("mean"), F.sqrt("v").alias("sd"), F.lit("player").alias("kind")))
    z = F.col("mean") / F.when(F.col("sd") > 0, F.col("sd"))
    # the normal distribution by its logistic approximation, within 0.0002
    p = 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))
    return rows.withColumns({"lower": F.col("mean") - 1.6449 * F.col("sd"), "upper": F.col("mean") + 1.6449 * F.col("sd"), "p_positive": p})


def posterior_score(rows: DataFrame, fit: RobustFit, key: str, player: str = "player_id", draws: int = 4000, seed: int = 3) -> DataFrame:
    """Median and probability of a rise of each row's expected change, and the 5 to 95 % range of the change with its noise.

    Draws of coefficients, intercepts and noise are made once and shared by all rows, so results depend neither on partitions nor
    on other rows; blocks of rows are scored as matrices. An unknown player has no intercept of its own. Null predictors and unknown
    positions raise an error.
    """
    rng = np.random.default_rng(seed)
    sample = rng.multivariate_normal(fit.beta, fit.covariance, draws).T
    own, noise = rng.standard_normal(draws), fit.sigma * rng.standard_t(fit.nu, draws)
    known = fit.players.select(F.col("player").alias(player), "u", F.sqrt("c").alias("su"), "h")
    position = [] if fit.position is None else [F.col(fit.position).cast("string").alias("position")]
    shape = (fit.predictors, fit.levels, "position" if position else None, fit.slopes)
    zeros = F.array_repeat(F.lit(0.0), len(fit.beta))
    joined = rows.select(F.col(key).alias("row_key"), player, *fit.predictors, *position).join(known, player, "left")
    joined = joined.withColumns({"u": F.coalesce("u", F.lit(0.0)), "su": F.coalesce("su", F.lit(0.0)), "h": F.coalesce("h", zeros)})
    beta = fit.beta

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        off = sample - beta[:, None]
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.iloc[a : a + 256]
                m, h = _design(part, *shape), np.stack(part["h"].tolist())
                if np.isnan(m).any():
                    raise ValueError("a predictor is null")
                d = m @ sample - h @ off + part["u"].to_numpy()[:, None] + part["su"].to_numpy()[:, None] * own
                y = d + noise
                low, high = np.quantile(y, (0.05, 0.95), axis=1)
                yield pd.DataFrame({"row_key": part["row_key"], "median": np.median(d, axis=1), "lower": low, "upper": high, "p_increase": (d > 0).mean(axis=1)})

    return joined.mapInPandas(score, "row_key long, median double, lower double, upper double, p_increase double")
