"""Edits of form states and merged statistics against computing everything again."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tempoframe.operators import ledger as led
from tempoframe.operators import moments as mom
from tempoframe.operators import ratings as rat
from tempoframe.operators.form import form_history, form_state
from tests.player_rows import player_rows

SCHEMA = "player_id long, match_id long, match_date date, minutes double, rating double"


def row(rng, player, match):
    return (player, match, dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(400)), float(rng.choice([0, 30, 90])), rng.choice([None, rng.random() * 9, rng.random() * 9]))


def states(df):
    return sorted((r.player_id, round(r.ewm_numerator, 6), round(r.ewm_denominator, 6), r.last_match_date, [x.match_id for x in r.recent]) for r in df.collect())


def histories(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select("player_id", "match_id", *led._FORM).collect())


def test_random_edits_equal_computing_again(spark):
    rng = random.Random(9)
    rows = {(p, p * 1000 + k): row(rng, p, p * 1000 + k) for p in range(8) for k in range((3, 30, 90)[p % 3])}
    frame = lambda r: spark.createDataFrame(list(r), SCHEMA)
    ledger, history = led.form_ledger(frame(rows.values())), form_history(frame(rows.values()))
    for step in range(3):
        edits = []
        for key in rng.sample(sorted(rows), 12):
            edits.append((*rows[key], "retract"))
            if rng.random() < 0.5:
                rows[key] = row(rng, *key)
                edits.append((*rows[key], "insert"))
            else:
                del rows[key]
        for k in range(6):
            new = row(rng, rng.randrange(10), 50_000 + step * 100 + k)
            rows[new[:2]] = new
            edits.append((*new, "insert"))
        if step == 1:  # all of a player, most of another
            for key in [k for k in rows if k[0] == 0 or k[0] == 2 and rng.random() < 0.8]:
                edits.append((*rows.pop(key), "retract"))
        frame_of = spark.createDataFrame(_cancelled(edits), SCHEMA + ", op string")
        history, ledger, routes = led.advanced(history, ledger, frame_of)
        assert states(led.state_of(ledger)) == states(form_state(frame(rows.values())))
        assert histories(history) == histories(form_history(frame(rows.values())))
        assert {r.route for r in routes.collect()} <= {"append", "recompute"}


def _cancelled(edits):
    """Without rows that are inserted and retracted at once."""
    inserted = {e[:5] for e in edits if e[5] == "insert"}
    retracted = {e[:5] for e in edits if e[5] == "retract"}
    return [e for e in edits if not (e[:5] in inserted and e[:5] in retracted)]


def test_states_that_lost_too_much_say_so(spark):
    rows = [(1, k, dt.date(2024, 1, 1) + dt.timedelta(days=k), 90.0, 5.0) for k in range(100)]
    ledger = led.form_ledger(spark.createDataFrame(rows, SCHEMA))
    few = spark.createDataFrame([(*r, "retract") for r in rows[-40:]], SCHEMA + ", op string")
    assert led.apply_edits(ledger, few).first()["complete"]
    most = spark.createDataFrame([(*r, "retract") for r in rows[-60:]], SCHEMA + ", op string")
    after = led.apply_edits(ledger, most)
    assert not after.first()["complete"]
    with pytest.raises(Exception, match="taken back"):
        led.state_of(after).collect()


def test_rows_that_follow_a_state_go_on_from_it(spark):
    rng = random.Random(2)
    rows = [(p, k, dt.date(2024, 1, 1) + dt.timedelta(days=2 * k), 90.0, rng.random() * 9) for p in range(4) for k in range(30)]
    whole = spark.createDataFrame(rows, SCHEMA)
    ledger = led.form_ledger(whole.where("match_id < 25 and player_id < 3"))
    got = led.form_continued(ledger, whole.where("match_id >= 25 or player_id = 3"))
    assert histories(got) == histories(form_history(whole).where("match_id >= 25 or player_id = 3"))


@pytest.fixture(scope="module")
def features(spark):
    rows = player_rows(spark)
    return rat.per90_log_features(rows, rat.pass_completion_prior(rows)).cache()


def close(a, b, keys):
    one, two = ({tuple(r[k] for k in keys): r for r in df.collect()} for df in (a, b))
    assert one.keys() == two.keys() and one
    for k, r in one.items():
        for c in r.asDict():
            if c not in keys:
                assert r[c] == pytest.approx(two[k][c], rel=1e-9, abs=1e-9), (k, c)


def test_merged_moments_equal_a_fit(features):
    close(mom.zscore_from(mom.feature_moments(features)), rat.zscore_fit(features), ["season", "position_group", "feature"])
    close(mom.prior_from(mom.pass_moments(features)), rat.pass_completion_prior(features), ["season", "position_group"])


def test_a_match_is_replaced(features):
    m = features.agg(F.min("match_id")).first()[0]
    changed = features.withColumn("passes", F.when(F.col("match_id") == m, F.col("passes") * 2 + 1).otherwise(F.col("passes"))).withColumn(
        "log_xg_90", F.when(F.col("match_id") == m, F.col("log_xg_90") + 1).otherwise(F.col("log_xg_90"))
    )
    one = changed.where(F.col("match_id") == m)
    assert one.count() > 0
    z = mom.zscore_from(mom.replaced(mom.feature_moments(features), mom.feature_moments(one)))
    close(z, rat.zscore_fit(changed), ["season", "position_group", "feature"])
    p = mom.prior_from(mom.replaced(mom.pass_moments(features), mom.pass_moments(one)))
    close(p, rat.pass_completion_prior(changed), ["season", "position_group"])


def test_versions_of_seasons(spark):
    rows = spark.createDataFrame([(s, m, p, float(p)) for s in ("a", "b") for m in range(5) for p in range(3)], "season string, match_id long, player_id long, x double")
    old = {r.season: r.version for r in mom.season_versions(mom.match_digests(rows)).collect()}
    edited = rows.withColumn("x", F.when((F.col("season") == "b") & (F.col("match_id") == 2) & (F.col("player_id") == 0), 9.0).otherwise(F.col("x"))).repartition(5)
    new = {r.season: r.version for r in mom.season_versions(mom.match_digests(edited)).collect()}
    assert new["a"] == old["a"] and new["b"] != old["b"]

def test_newest_form_whatever_the_order_of_rows(spark):
    from tempoframe.operators.serving import lateral_top1

    forms = spark.range(0, 60000, numPartitions=9).selectExpr("id % 500 AS player_id", "id AS match_id", "date_add(date'2000-01-01', cast(id * 7919 % 3001 AS int)) AS match_date", "cast(id AS double) AS rating")
    values = spark.range(0, 60000, numPartitions=9).selectExpr("id % 500 AS player_id", "id AS market_value", "date_add(date'2000-01-01', cast(id * 7919 % 60013 AS int)) AS valuation_date")
    forms, values = forms.repartition(16), values.repartition(16)
    got = lateral_top1(spark.range(500).selectExpr("id AS player_id"), forms, values).collect()
    newest = {r.player_id: r.m for r in forms.groupBy("player_id").agg(F.max(F.struct("match_date", "match_id")).alias("m")).collect()}
    dearest = {r.player_id: r.m for r in values.groupBy("player_id").agg(F.max(F.struct("valuation_date", "market_value")).alias("m")).collect()}
    assert all(r.newest_match == newest[r.player_id].match_id and r.newest_value == dearest[r.player_id].market_value for r in got) and len(got) == 500
    plan = lateral_top1(spark.range(500).selectExpr("id AS player_id"), forms, values)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan  # a limit becomes row numbers in no order, which leave the newest row to chance
