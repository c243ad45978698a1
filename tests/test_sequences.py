"""Carries, defensive value and form against plain loops; rules with known results."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tempoframe.operators import appearances as app
from tempoframe.operators import entities as ent
from tempoframe.operators import evaluation as eva
from tempoframe.operators import form as frm
from tempoframe.operators import incremental as inc
from tempoframe.operators import ingest as ing
from tempoframe.operators import passes as pas
from tempoframe.operators import ratings as rat
from tempoframe.operators import sequences as seq
from tempoframe.operators import serving as ser
from tempoframe.operators import valuation as val
from tempoframe.functions.text import normalize_name

EVENTS = "match_id long, event_id long, team_id long, player_id long, period_value long, event_time_seconds long, type_name string, outcome_name string, x double, y double, end_x double, end_y double"


def random_events(n, seed):
    rng = random.Random(seed)
    kinds = ["Pass"] * 6 + ["TakeOn", "Challenge", "Foul", "Card", "Tackle", "BallRecovery", "Goal", "Clearance", "SubstitutionOn"]
    t, rows = 0, []
    for i in range(n):
        t = 0 if i == n // 2 else t + rng.choice([0, 1, 2, 3, 6, 20])
        place = [round(rng.uniform(0, 100), 2) for _ in range(4)]
        end = (None, None) if rng.random() < 0.1 else place[2:]
        rows.append((i % 2, i, rng.choice([1, 2]), rng.randrange(1, 12), 1 if i < n // 2 else 2, t, rng.choice(kinds), rng.choice(["Successful", "Successful", "Unsuccessful"]), *place[:2], *end))
    return rows


def loop_carries(rows):
    names = [c.split()[0] for c in EVENTS.split(", ")]
    events = sorted((dict(zip(names, r, strict=True)) for r in rows), key=lambda e: (e["match_id"], e["period_value"], e["event_time_seconds"], e["event_id"]))
    found = set()
    for i, p in enumerate(events):
        if p["type_name"] not in seq.CARRY_FROM or p["outcome_name"] != "Successful" or p["end_x"] is None:
            continue
        dribbles, target = 0, None
        for n in events[i + 1 :]:
            if (n["match_id"], n["period_value"]) != (p["match_id"], p["period_value"]):
                break
            if n["type_name"] in (*seq.IGNORED, "Foul"):
                continue
            if n["type_name"] == "TakeOn":
                dribbles += n["outcome_name"] == "Successful"
                continue
            if n["team_id"] != p["team_id"] and n["type_name"] == "Challenge" and n["outcome_name"] == "Unsuccessful":
                continue
            target = n
            break
        if not target or target["team_id"] != p["team_id"] or target["type_name"] not in seq.CARRY_TO:
            continue
        metres = (((target["x"] - p["end_x"]) * 1.05) ** 2 + ((target["y"] - p["end_y"]) * 0.68) ** 2) ** 0.5
        if 1 <= target["event_time_seconds"] - p["event_time_seconds"] <= 10 and 5 <= metres <= 60:
            found.add((p["event_id"], target["event_id"], dribbles))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_carries_equal_a_loop(spark, seed):
    rows = random_events(600, seed)
    got = seq.infer_carries(spark.createDataFrame(rows, EVENTS)).collect()
    assert {(r.source_event_id, r.target_event_id, r.take_ons) for r in got} == loop_carries(rows) and got


def test_defensive_value_sources(spark):
    rows = [
        (1, 1, 2, 5, 1, 0, "Pass", "Successful", 50.0, 50.0, 80.0, 50.0), (1, 2, 1, 4, 1, 5, "Tackle", "Successful", 20.0, 50.0, None, None),
        (1, 3, 1, 4, 1, 8, "Pass", "Successful", 20.0, 50.0, 30.0, 50.0), (1, 4, 1, 4, 1, 40, "Clearance", "Unsuccessful", 10.0, 40.0, None, None),
    ]
    grid = spark.range(96).select(F.col("id").alias("zone"), (F.col("id") % 12 / 12).alias("grid_value"))
    got = {r.event_id: r for r in seq.defensive_value(spark.createDataFrame(rows, EVENTS), grid).collect()}
    assert (got[2].before_source, got[2].after_source) == ("previous_opponent_event", "defending_team_next_event")
    assert got[2].net_threat_reduction == pytest.approx(9 / 12)
    assert (got[4].before_source, got[4].after_source) == ("mirrored_defensive_location", "no_next_event_successful_stop")


def test_appearance_minutes_and_inherited_position(spark):
    lineups = spark.createDataFrame([(1, 10, True, None, "FW"), (1, 11, False, None, "Sub"), (1, 20, True, None, "DC"), (1, 30, False, None, "Sub"), (1, 40, False, 33.0, "MC")], "match_id long, player_id long, started boolean, minutes double, code string")
    events = spark.createDataFrame([(1, 20, 80, 2, "Red"), (1, 10, 5, 1, None)], "match_id long, player_id long, minute int, period_value int, card_type string")
    subs = spark.createDataFrame([(1, 11, 10, "SubstitutionOn", 60)], "match_id long, player_id long, related_player_id long, type_name string, event_minute int")
    got = {r.player_id: (r.minutes, r.minutes_source) for r in app.appearance_minutes(lineups, events, subs).collect()}
    assert got == {10: (60.0, "derived_lineup_events"), 11: (30.0, "derived_lineup_events"), 20: (80.0, "derived_lineup_events"), 30: (0.0, "not_played"), 40: (33.0, "provider")}
    placed = lineups.withColumn("position_group", app.position_group(F.col("code"), "lenient"))
    assert {r.player_id: r.position_group for r in app.propagate_positions(placed, subs).collect()} == {10: "Forward", 11: "Forward", 20: "Defender", 30: None, 40: "Midfielder"}


def test_rating_rules(spark):
    curve = [spark.range(1).select(rat.outfield_rating(F.lit(z))).first()[0] for z in (0.0, 2.5, 5.0)]
    assert curve[0] == 6 and 8 <= curve[1] <= 8.2 and curve[2] < 9.1
    prior = rat.pass_completion_prior(spark.createDataFrame([("s", "Forward", 2, 0), ("s", "Forward", 10, 8)], "season string, position_group string, passes int, completed_passes int")).first()
    assert prior.match_rows == 1 and prior.pass_completion_prior == 0.8
    flags = dict(is_corner=0, is_free_kick=0, is_throw_in=0, is_goal_kick=0)
    rows = [dict(match_id=1, player_id=7, x=40.0, end_x=60.0, success=1, is_key_pass=0, is_assist=0, **flags), dict(match_id=1, player_id=7, x=40.0, end_x=42.0, success=0, is_key_pass=0, is_assist=0, **flags), dict(match_id=1, player_id=7, x=99.0, end_x=90.0, success=1, is_key_pass=1, is_assist=1, **(flags | {"is_corner": 1}))]
    got = pas.pass_totals(spark.createDataFrame(rows)).first()
    assert (got["passes"], got.completed_passes, got.progressive_passes, got.assists) == (2, 1, 1, 1)


def loop_form(rows):
    out, state = {}, {}
    for p, m, d, minutes, rating in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        s = state.setdefault(p, {"n": 0.0, "d": 0.0, "last": d, "recent": []})
        decay = 2 ** (-(d - s["last"]).days / 90)
        s["n"], s["d"], s["last"] = s["n"] * decay, s["d"] * decay, d
        if rating is not None and (minutes or 0) > 0:
            s["n"], s["d"] = s["n"] + minutes * rating, s["d"] + minutes
            s["recent"] = [*s["recent"], (minutes, rating)][-20:]
        mean = lambda xs: sum(a * b for a, b in xs) / sum(a for a, _ in xs) if xs else None
        out[p, m] = (s["n"] / s["d"] if s["d"] else None, mean(s["recent"][-3:]), mean(s["recent"]))
    return out


RATINGS = "player_id long, match_id long, match_date date, minutes double, rating double"


def test_form_equals_a_loop(spark):
    rng = random.Random(9)
    start = dt.date(2020, 1, 1)
    rows = [(p, m, start + dt.timedelta(days=m * 4 + p), rng.choice([0.0, 30.0, 90.0, None]), rng.choice([None, round(rng.uniform(3, 9), 2)])) for p in range(6) for m in range(40)]
    df = spark.createDataFrame(rows, RATINGS)
    want = loop_form(rows)
    for r in frm.form_history(df).collect():
        assert (r.form_rating_ewm, r.rolling_3_match_rating, r.rolling_20_match_rating) == pytest.approx(want[r.player_id, r.match_id])
    cut = start + dt.timedelta(days=90)
    state = {r.player_id: r for r in frm.form_append(frm.form_state(df.where(F.col("match_date") < cut)), df.where(F.col("match_date") >= cut)).collect()}
    for r in frm.form_state(df).collect():
        assert state[r.player_id].ewm_numerator == pytest.approx(r.ewm_numerator) and state[r.player_id].recent == r.recent
    with pytest.raises(Exception, match="before the stored last match"):
        frm.form_append(frm.form_state(df), df.where(F.col("match_date") < cut)).collect()


def test_valuations_do_not_leak(spark):
    day = lambda m, d: dt.date(2024, m, d)
    ratings = spark.createDataFrame([(1, 1, day(1, 10), 90.0, 5.0, "F"), (1, 2, day(2, 10), 90.0, 7.0, "F"), (1, 3, day(3, 1), 90.0, 9.0, "F")], RATINGS + ", position_group string")
    values = spark.createDataFrame([(1, day(1, 1), 100), (1, day(3, 1), 120), (2, day(1, 1), 5)], "player_id long, valuation_date date, market_value long")
    row = val.valuation_feature_table(val.valuation_intervals(val.valuation_clean(values), ratings), ratings, 1).first()
    assert (row.matches, row.asof_last_3, row.days_between) == (2, 6.0, 60)


def test_names_links_labels_and_upserts(spark):
    names = spark.createDataFrame([("Radu Drăgușin",), ("  Micky   van-de Ven ",), (None,)], "n string").select(normalize_name("n").alias("k"))
    assert [r.k for r in names.collect()] == ["radu dragusin", "micky van de ven", None]
    labels = spark.createDataFrame([("2025",), ("2025/26",), ("2025_2026",), ("1999/00",), ("x",)], "s string").select(ing.normalize_season_label(F.col("s")).alias("k"))
    assert [r.k for r in labels.collect()] == ["2025-2026"] * 3 + ["1999-2000", None]
    target, source = (spark.createDataFrame(rows, "id long, v string") for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d"), (3, "e")]))
    once = ser.merge_upsert(target, source, ["id"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, ser.merge_upsert(once, source, ["id"]).collect()))
    with pytest.raises(Exception, match="not one to one"):
        ent.assert_one_to_one(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"), "a", "b").collect()


def test_work_and_splits(spark):
    items = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i)) for i in range(8)], "item_id long, item_date date")
    got = {r.item_id: r.status for r in inc.select_new_work(items, items.where("item_id = 0"), "2024-01-06", 2).collect()}
    assert got == {0: "completed", 1: "waiting", 2: "waiting", 3: "waiting", 4: "selected", 5: "selected", 6: "deferred", 7: "deferred"}
    assert [r.part for r in eva.chronological_split(items, "item_date", 0.25).orderBy("item_id").collect()] == ["train"] * 7 + ["test"]
    with pytest.raises(ValueError):
        eva.chronological_split(items.limit(3), "item_date")
