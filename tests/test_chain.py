"""The whole chain on planted values."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoframe.operators import chain
from tempoframe.operators.entities import collect_entities, match_entities, review_queue
from tempoframe.operators.journal import Journal
from tempoframe.operators.player_match import match_outcomes
from tests.player_rows import player_rows


def test_chain(spark, tmp_path):
    """A planted dependence of value changes on ratings is found; estimates are made if the gate promotes the model."""
    rng = np.random.default_rng(3)
    ratings, values = [], []
    for p in range(40):
        worth, day = 1e6, dt.date(2021, 1, 1)
        values.append((p, day, int(worth), 20.0 + p % 12))
        for k in range(10):
            skill = rng.normal(6, 1.5)
            for m in range(4):
                ratings.append((p, p * 1000 + k * 10 + m, day + dt.timedelta(days=10 + 15 * m), 90.0, float(skill + rng.normal(0, 0.2)), ("Defender", "Forward")[p % 2], 1))
            day += dt.timedelta(days=90)
            worth *= math.exp(0.15 * (skill - 6) + rng.normal(0, 0.05))
            values.append((p, day, int(worth), 20.0 + p % 12 + (k + 1) / 4))
    rated = spark.createDataFrame(ratings, "player_id long, match_id long, match_date date, minutes double, rating double, position_group string, started int")
    worths = spark.createDataFrame(values, "player_id long, valuation_date date, market_value long, age_at_valuation double")
    path = f"file://{tmp_path}"
    record = {r["stage"]: r for r in chain.run(worths, rated, "2023-06-15", path).orderBy("step").collect()}
    assert list(record) == ["rated", "form", "intervals", "features", "metrics", "effects", "gate", "current", "estimates", "players", "run"]
    assert record["features"]["rows"] == 400 and record["players"]["rows"] == 40 and record["run"]["status"] == "succeeded"
    kept = Journal(spark, path)
    metrics = {r["model"]: r for r in kept.latest("metrics").collect()}
    assert metrics["student_t"]["r2"] > 0.5 and metrics["student_t"]["mae"] < metrics["zero_change"]["mae"]
    assert metrics["zero_change"]["spearman"] is None
    gate = kept.latest("gate").first()["promoted"]
    assert record["estimates"]["status"] == ("succeeded" if gate else "skipped_not_promoted") and (record["estimates"]["rows"] > 0) == gate
    again = {r["stage"]: r["status"] for r in chain.run(worths, rated, "2023-06-15", path).collect()}
    assert set(again.values()) == {"reused", "succeeded"} and [k for k, v in again.items() if v == "succeeded"] == ["run"]


def test_a_run_goes_on_where_it_failed(spark, tmp_path):
    path, made = f"file://{tmp_path}", []

    def work(fail):
        def steps(j):
            j.input("numbers", spark.range(10))
            one = j.stage("one", ["numbers"], lambda _: made.append("one") or spark.range(10).selectExpr("id + 1 AS id"))

            def two(_):
                made.append("two")
                if fail:
                    raise RuntimeError("no space")
                return one.where("id > 5")

            j.stage("two", ["one"], two)

        return steps

    with pytest.raises(RuntimeError, match="no space"):
        Journal(spark, path).whole(work(True))
    last = {(r.stage, r.status): r.error for r in Journal(spark, path).records().collect()}
    assert "no space" in last[("two", "failed")] and "no space" in last[("run", "failed")] and ("one", "succeeded") in last
    done = {r.stage: r.status for r in Journal(spark, path).whole(work(False)).collect()}
    assert made == ["one", "two", "two"] and done == {"one": "reused", "two": "succeeded", "run": "succeeded"}
    assert Journal(spark, path).latest("two").count() == 5
    newer = {r.stage: r.status for r in Journal(spark, path, "2").whole(work(False)).collect()}
    assert newer["one"] == newer["two"] == "succeeded"


def test_candidates_are_mapped(spark):
    rows = player_rows(spark, 3, 4).withColumn("player_name", F.concat(F.lit("Name "), F.col("player_id").cast("string")))
    names = collect_entities(rows.withColumns({"team_id": F.lit(1), "position": F.lit("x")}))
    candidates = spark.createDataFrame([(90, "name 0"), (91, "name 1"), (92, "name 9"), (93, "name 1")], "candidate_id long, name_key string")
    overrides = spark.createDataFrame([(2, 92)], "player_id long, candidate_id long")
    mapping = match_entities(names, candidates, overrides)
    assert sorted((r.player_id, r.candidate_id) for r in mapping.collect()) == [(0, 90), (2, 92)]
    assert {r.player_id: r.reason for r in review_queue(names, candidates, mapping).collect()} == {1: "ambiguous", 3: "none"}


def test_one_bad_match_leaves_the_others_alone(spark):
    lineups = spark.createDataFrame([(m, p, 1, 131.0 if (m, p) == (2, 1) else 90.0, "Forward" if (m, p) != (3, 0) else "Unknown") for m in (1, 2, 3) for p in range(3)] + [(4, 0, 0, 0.0, "Forward")], "match_id long, player_id long, started int, minutes double, position_group string")
    events = spark.createDataFrame([(m, 0, "Pass") for m in (1, 2, 3, 4)], "match_id long, player_id long, type_name string")
    pending = spark.createDataFrame([(m,) for m in (1, 2, 3, 4, 5)], "match_id long")
    got = {r.match_id: (r.status, r.error) for r in match_outcomes(pending, lineups, events).collect()}
    assert got == {
        1: ("processed", None), 2: ("failed", "invalid minutes"), 3: ("failed", "unknown position"), 4: ("failed", "appearance minutes are missing"), 5: ("failed", "no player took part"),
    }
