"""Random player-match rows for tests of ratings."""

from __future__ import annotations

import datetime as dt
import random

from tempoframe.plans.players import TOTALS

GROUPS = ("Goalkeeper", "Defender", "Defender", "Midfielder", "Midfielder", "Forward")


def player_rows(spark, matches=16, players=12, seed=1):
    """Every player in every match; matches, a day each, alternate between two seasons, and ``k`` is their place."""
    rng, rows = random.Random(seed), []
    for k in range(matches):
        for p in range(players):
            counts = [float(rng.choice([0, 1, 2, 5])) + (rng.random() if name.startswith("x") else 0) for name in TOTALS]
            rows.append((100 + k, p, k % 2, k, dt.date(2024, 8, 1) + dt.timedelta(days=3 * k), GROUPS[p % 6], float(rng.choice([20, 60, 90])), rng.random(), *counts))
    schema = "match_id long, player_id long, s long, k long, match_date date, position_group string, minutes double, xpv_added double, " + ", ".join(f"{c} double" for c in TOTALS)
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schema).withColumn("season", F.when(F.col("s") == 0, "a").otherwise("b")).drop("s")
