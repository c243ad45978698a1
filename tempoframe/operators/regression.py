"""Least squares with robust errors from orthogonal factors of blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks that put the triangular factors of all tasks together, at most, before the driver does so with theirs.
FACTORS = 64


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def _summed(rows: DataFrame, task) -> np.ndarray:
    """The sum of the vectors that ``task`` makes of batches; tasks return one each."""

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum((task(b) for b in batches if len(b)), 0.0)
        if np.ndim(total):
            yield pd.DataFrame({"i": np.arange(len(total)), "s": total})

    got = rows.mapInPandas(added, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toPandas()
    return got.sort_values("i")["s"].to_numpy()


def ols_robust(rows: DataFrame, target: str, predictors: Sequence[str], position: str | None = None, levels: Sequence[str] | None = None) -> DataFrame:
    """Least squares with intercept and HC3 errors: one row per term with coefficient, error, z and p-value.

    ``position`` adds a 0/1 column for each of its sorted levels (those in ``levels``, else of the rows) but the first, named ``position_<level>``.
    Rows with a null in target, predictors or position are left out; a position outside ``levels`` counts as the first.

    Every task reduces its centred and scaled rows to a triangular factor, factors are stacked and reduced again, and only the last ones reach the
    driver: no cross products are formed, so nearly dependent columns (a year, an age and its square) lose no digits. Columns that depend on
    others share the coefficient of least norm. A second pass takes leverages from the factor and adds up the squared, leverage-adjusted residuals.
    """
    predictors = list(predictors)
    used = rows.dropna(subset=[target, *predictors, *([position] if position else [])])
    used = used.select(*(F.col(c).cast("double").alias(c) for c in (*predictors, target)), *([F.col(position).cast("string").alias("_place")] if position else []))
    if position and levels is None:
        levels = sorted(r[0] for r in used.select("_place").distinct().collect())
    dummies = list(levels or [])[1:]
    got = used.agg(F.count("*"), *(F.avg(c) for c in predictors), *(F.stddev_pop(c) for c in predictors)).first()
    if not got[0]:
        raise ValueError("no row is complete")
    mean = np.array(got[1 : 1 + len(predictors)], float)
    scale = np.array([s or 1.0 for s in got[1 + len(predictors) :]], float)
    k = 1 + len(predictors) + len(dummies)

    def design(batch: pd.DataFrame) -> np.ndarray:
        x = [np.ones((len(batch), 1)), (batch[predictors].to_numpy(float) - mean) / scale]
        return np.hstack([*x, *((batch[["_place"]] == v).to_numpy(float) for v in dummies)])

    def factored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = None
        for batch in batches:
            if len(batch):
                a = np.column_stack([design(batch), batch[target].to_numpy(float)])
                r = _stacked([a] if r is None else [r, a])
        if r is not None:
            yield pd.DataFrame({"r": list(r)})

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [np.stack(b["r"].tolist()) for b in batches if len(b)]
        if parts:
            yield pd.DataFrame({"r": list(_stacked(parts))})

    few = min(FACTORS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    factors = used.mapInPandas(factored, "r array<double>").repartition(few).mapInPandas(joined, "r array<double>")
    r = _stacked([np.array([x[0] for x in factors.collect()])])
    r = np.vstack([r, np.zeros((max(0, k + 1 - len(r)), k + 1))])
    inverse = np.linalg.pinv(r[:k, :k], rcond=1e-11)
    beta = inverse @ r[:k, k]

    def squared(batch: pd.DataFrame) -> np.ndarray:
        x = design(batch)
        free = 1 - ((x @ inverse) ** 2).sum(axis=1)
        e = np.where(free > 1e-10, (batch[target].to_numpy(float) - x @ beta) / np.maximum(free, 1e-10), 0.0)
        return (x.T @ (x * (e**2)[:, None])).ravel()

    # Back to the columns as they came: those of predictors are divided by their deviation, and the intercept takes their means.
    back = np.eye(k)
    back[1 : 1 + len(predictors), 1 : 1 + len(predictors)] = np.diag(1 / scale)
    back[0, 1 : 1 + len(predictors)] = -mean / scale
    bread = back @ inverse @ inverse.T
    error = np.sqrt(np.maximum(np.diag(bread @ _summed(used, squared).reshape(k, k) @ bread.T), 0))
    out = []
    for name, b, e in zip(["intercept", *predictors, *(f"position_{v}" for v in dummies)], back @ beta, error, strict=True):
        z = b / e if e > 0 else 0.0
        out.append((name, float(b), float(e), float(z), math.erfc(abs(z) / math.sqrt(2))))
    return rows.sparkSession.createDataFrame(out, "term string, coefficient double, std_error double, z double, p_value double")


def predicted(rows: DataFrame, fitted: DataFrame, name: str, position: str | None = None) -> DataFrame:
    """``rows`` with the prediction of an ``ols_robust`` fit in the column ``name``."""
    terms = {r["term"]: r["coefficient"] for r in fitted.collect()}  # a row a term
    total = F.lit(terms.pop("intercept"))
    for term, b in terms.items():
        if position is not None and term.startswith("position_"):
            total = total + F.when(F.col(position).cast("string") == term.removeprefix("position_"), b).otherwise(0.0)
        else:
            total = total + F.col(term) * b
    return rows.withColumn(name, total)
