"""Ranks and quantiles against sorting."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tempoframe.functions import ranks


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_quantiles_equal_sorting(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([rng.random(), float(rng.randrange(5))]), None if i % 3 == 0 else float(rng.randrange(9)), None) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    shares = (0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0)
    wanted = {f"{c}{k}": (c, q) for c in "abc" for k, q in enumerate(shares)}
    smooth, steps = ranks.quantiles(df, wanted).first(), ranks.quantiles(df, wanted, discrete=True).first()
    for c, values in (("a", [r[0] for r in rows]), ("b", sorted(r[1] for r in rows if r[1] is not None)), ("c", [])):
        for k, q in enumerate(shares):
            if not values:
                assert smooth[f"{c}{k}"] is None and steps[f"{c}{k}"] is None
                continue
            assert smooth[f"{c}{k}"] == pytest.approx(np.quantile(values, q))
            ordered = sorted(values)
            assert steps[f"{c}{k}"] == next(v for i, v in enumerate(ordered) if (i + 1) / len(ordered) >= q)


def test_average_ranks_of_ties(spark):
    rng = random.Random(2)
    values = [rng.randrange(40) / 2 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    got = {r.v: r.rank for r in ranks.average_ranks(df, "v", "rank").collect()}
    ordered = sorted(values)
    assert got == {v: ordered.index(v) + (ordered.count(v) + 1) / 2 for v in set(values)}


def test_nothing_to_rank(spark):
    df = spark.createDataFrame([], "v double")
    assert ranks.average_ranks(df, "v", "rank").count() == 0 and ranks.quantiles(df, {"m": ("v", 0.5)}).first()["m"] is None
