"""Splitting, preparing, fitting and judging models on tables."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoframe.functions.ranks import average_ranks, quantiles
from tempoframe.operators.preparation import apply_codes, fit_codes, fit_preparation

RISE, FALL = math.log(1.10), math.log(0.90)


def chronological_split(rows: DataFrame, date: str, test_share: float = 0.2) -> DataFrame:
    """Adds ``part``: train up to the split date, test after it. The date is that at the place of the share among the different dates; at least five are needed."""
    if not 0.05 <= test_share <= 0.5:
        raise ValueError("test_share is between 0.05 and 0.5")
    dates = rows.where(F.col(date).isNotNull()).select(date).distinct()
    n = dates.count()
    if n < 5:
        raise ValueError("a split needs five different dates")
    at = min(n - 2, max(1, int(n * (1 - test_share))))
    cut = dates.orderBy(date).offset(at).limit(1).first()[0]
    return rows.withColumn("part", F.when(F.col(date) <= F.lit(cut), "train").otherwise("test"))


def impute_standardize(rows: DataFrame, columns: list[str], train: Column) -> DataFrame:
    """Columns with nulls replaced by the training median, then centred and scaled by training mean and population deviation (one if it is zero)."""
    return fit_preparation(rows.where(train), columns).apply(rows)


def category_codes(rows: DataFrame, column: str, levels_from: Column | None = None) -> DataFrame:
    """Adds ``<column>_code``: the place of the level among the sorted levels (of the chosen rows); an unknown level gets their number."""
    return apply_codes(rows, fit_codes(rows if levels_from is None else rows.where(levels_from), column), column)


def baseline_predictions(rows: DataFrame, previous: str = "previous_log_change") -> DataFrame:
    """Adds the two baselines: no change, and the change before (none: zero)."""
    return rows.withColumns({"zero_change": F.lit(0.0), "previous_change": F.coalesce(F.col(previous), F.lit(0.0))})


def _direction(c: Column) -> Column:
    return F.when(c > RISE, 1).when(c < FALL, -1).otherwise(0)


def regression_metrics(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row of errors, R², three-class direction accuracy and rank correlation; pairs with a null are left out.

    R² is null where the actual values are all equal, the rank correlation where either side is.
    """
    pairs = rows.select(F.col(actual).cast("double").alias("a"), F.col(predicted).cast("double").alias("p")).dropna()
    ranked = average_ranks(average_ranks(pairs, "a", "_rank_a"), "p", "_rank_p")
    e = F.col("p") - F.col("a")
    return ranked.agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), (F.exp(F.avg(F.abs(e))) - 1).alias("approximate_mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop("a") * F.count("*"))).alias("r2"), F.avg((_direction(F.col("a")) == _direction(F.col("p"))).cast("double")).alias("direction_accuracy"),
        F.try_divide(F.covar_pop("_rank_a", "_rank_p"), F.stddev_pop("_rank_a") * F.stddev_pop("_rank_p")).alias("spearman"), F.avg(e).alias("mean_error"),
    )


def calibration_deciles(rows: DataFrame, actual: str, predicted: str, bins: int = 10) -> DataFrame:
    """Bins by quantile edges of the prediction (equal edges once), right-closed: size, means and the share of rises."""
    pairs = rows.select(F.col(actual).cast("double").alias("a"), F.col(predicted).cast("double").alias("p")).dropna()
    found = quantiles(pairs, {f"_{k}": ("p", k / bins) for k in range(bins + 1)})
    edges = found.select(F.array_distinct(F.array(*found.columns)).alias("edges"))
    # the first bin takes the lowest edge too
    bin_of = F.greatest(F.size(F.filter("edges", lambda e: e < F.col("p"))) - 1, F.lit(0))
    placed = pairs.crossJoin(F.broadcast(edges)).withColumn("bin", bin_of.cast("long"))  # one row
    return placed.groupBy("bin").agg(F.count("*").alias("n"), F.avg("p").alias("mean_predicted"), F.avg("a").alias("mean_actual"), F.avg((F.col("a") > 0).cast("double")).alias("share_rising"))


def _poisson(keys: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Weights of mean one for each draw (rows) and key (columns), from a mix of both; each 64 bits give the weights of two draws."""
    with np.errstate(over="ignore"):
        z = keys[None, :] ^ (draws[:, None] * np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    u = np.concatenate([(z >> np.uint64(32)).astype(np.uint32), z.astype(np.uint32)])
    weight, total, term = np.zeros(u.shape, np.uint8), 0.0, math.exp(-1.0)
    for k in range(1, 13):
        total += term
        weight += u >= np.uint32(min(round(total * 2**32), 2**32 - 1))
        term /= k
    return weight


def bootstrap_difference(rows: DataFrame, actual: str, a: str, b: str, samples: int = 5000, seed: int = 7, key: str | None = None) -> DataFrame:
    """Resampled difference of mean absolute errors (``a`` less ``b``): mean, limits and the share below zero.

    Each row enters a sample with a Poisson weight drawn from a hash of seed, sample and row key, so tasks need no shared draw and retries repeat it. ``key`` names a
    column that no two rows share; without one, rows that are equal in all columns are drawn together, which widens the limits.
    Equal in distribution to drawing rows with replacement, not in numbers. Tasks add up the weighted errors block by block and return one row per sample.
    """
    e = F.abs(F.col(a) - F.col(actual)) - F.abs(F.col(b) - F.col(actual))
    base = rows.select(F.xxhash64(F.lit(seed), *(rows.columns if key is None else [key])).alias("key"), e.cast("double").alias("e")).dropna()
    half = (samples + 1) // 2

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, weights = np.zeros(2 * half), np.zeros(2 * half)
        for batch in batches:
            keys, values = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for at in range(0, len(keys), 2048):
                columns = np.stack([values[at : at + 2048], np.ones(len(keys[at : at + 2048]))], axis=1)
                for low in range(0, half, 64):
                    draws = np.arange(low, min(low + 64, half), dtype=np.uint64)
                    got = _poisson(keys[at : at + 2048], draws + np.uint64(1)).astype(np.float64) @ columns
                    for part, first in ((got[: len(draws)], low), (got[len(draws) :], half + low)):
                        sums[first : first + len(draws)] += part[:, 0]
                        weights[first : first + len(draws)] += part[:, 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(samples)), pa.array(sums[:samples]), pa.array(weights[:samples])], names=["rep", "s", "w"])

    sums = base.mapInArrow(added, "rep long, s double, w double").groupBy("rep").agg(F.try_divide(F.sum("s"), F.sum("w")).alias("d"))  # a sample without rows counts for nothing
    return sums.agg(
        F.avg("d").alias("mean_difference"), F.expr("percentile(d, 0.025)").alias("lower"), F.expr("percentile(d, 0.975)").alias("upper"), F.avg((F.col("d") < 0).cast("double")).alias("p_below_zero")
    )


def interval_coverage(rows: DataFrame, actual: str, lower: str, upper: str) -> DataFrame:
    """Share of values inside their interval, and its median width."""
    share = rows.agg(F.avg(F.col(actual).between(F.col(lower), F.col(upper)).cast("double")).alias("coverage"))
    width = rows.select((F.col(upper) - F.col(lower)).alias("w"))
    return share.crossJoin(F.broadcast(quantiles(width, {"median_width": ("w", 0.5)})))  # one row each


def promotion_gate(metrics: DataFrame) -> DataFrame:
    """Checks of a candidate's metrics row against the baselines in it, and whether all pass; a fitted candidate's row says in ``converged`` if its fit did."""
    tests = {
        "beats_zero_mae": F.col("mae") < F.col("zero_mae"),
        "beats_zero_direction": F.col("direction_accuracy") > F.col("zero_direction"),
        "beats_ols_mae": F.col("mae") < F.col("ols_mae"),
        "positive_r2": F.col("r2") > 0,
        "coverage": F.col("coverage") >= 0.80,
    }
    if "converged" in metrics.columns:
        tests["em_converged"] = F.col("converged")
    rows = metrics.select(F.inline(F.array(*(F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in tests.items()))))
    return rows.crossJoin(F.broadcast(rows.agg(F.bool_and("passed").alias("promoted"))))  # one row
