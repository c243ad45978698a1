"""The routes of an update of ratings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tempoframe.operators import ledger as led
from tempoframe.operators import ratings as rat
from tempoframe.operators import updates as upd
from tempoframe.operators.form import form_history, form_state
from tests.player_rows import player_rows


@pytest.fixture(scope="module")
def features(spark):
    return player_rows(spark).cache()


def kept(spark, path):
    """The stored ratings, which must be consistent: form and states are those of the rated rows."""
    table = upd.stored(spark, path, "ratings").cache()
    rows = lambda df: sorted((r.player_id, r.match_id, r.rating is None or round(r.rating, 6), r.form_rating_ewm and round(r.form_rating_ewm, 6), r.rolling_20_match_rating and round(r.rolling_20_match_rating, 6)) for r in df.collect())
    assert rows(table) == rows(form_history(table.drop(*led._FORM)))
    flat = lambda df: sorted((r.player_id, round(r.ewm_numerator, 5), round(r.ewm_denominator, 5), r.last_match_date, len(r.recent)) for r in df.collect())
    assert flat(led.state_of(upd._ledger(spark, path))) == flat(form_state(table))
    return {(r.player_id, r.match_id): r.rating for r in table.collect()}


def test_four_routes(spark, tmp_path, features):
    path = f"file://{tmp_path}/ratings"
    n = features.agg(F.max("k")).first()[0]
    first = features.where((F.col("k") < n - 6) & (F.col("k") != 4))
    assert upd.update_ratings(first, path).first()["route"] == "fit"
    one = kept(spark, path)
    want = {(r.player_id, r.match_id): r.post_match_rating for r in rat.rate_matches(first).collect()}
    assert one == pytest.approx(want)

    assert tuple(upd.update_ratings(first, path).first()) == ("reuse", 0, 0, 0, 0)

    later = features.where((F.col("k") < n - 2) & (F.col("k") != 4))
    got = upd.update_ratings(later, path).first()
    assert (got["route"], got["new_matches"], got["fitted_seasons"]) == ("append", 4, 0)
    two = kept(spark, path)
    assert {k: two[k] for k in one} == one and len(two) > len(one)  # frozen: what was rated stays
    frozen = rat.rate_matches(features.where((F.col("k") >= n - 6) & (F.col("k") < n - 2)), *(upd.stored(spark, path, t) for t in ("priors", "stats")))
    assert {k: two[k] for k in two.keys() - one.keys()} == pytest.approx({(r.player_id, r.match_id): r.post_match_rating for r in frozen.collect()})

    late = features.where(F.col("k") < n - 2)
    got = upd.update_ratings(late, path).first()
    assert got["route"] == "recompute" and got["recomputed_players"] > 0 and got["new_matches"] == 1
    three = kept(spark, path)
    assert {k: three[k] for k in two} == two

    versions = {r.season: r.version for r in upd.stored(spark, path, "versions").collect()}
    corrected = late.withColumn("xg", F.when(F.col("k") == 3, F.col("xg") + 1).otherwise(F.col("xg")))  # of season b
    got = upd.update_ratings(corrected, path).first()
    assert (got["route"], got["changed_matches"], got["fitted_seasons"]) == ("refit", 1, 1)
    four = kept(spark, path)
    seasons = {r.match_id: r.season for r in features.select("match_id", "season").distinct().collect()}
    assert {k: v for k, v in four.items() if seasons[k[1]] == "a"} == {k: v for k, v in three.items() if seasons[k[1]] == "a"}
    again = {(r.player_id, r.match_id): r.post_match_rating for r in rat.rate_matches(corrected.where("season = 'b'")).collect()}
    assert {k: v for k, v in four.items() if seasons[k[1]] == "b"} == pytest.approx(again)
    now = {r.season: r.version for r in upd.stored(spark, path, "versions").collect()}
    assert now["a"] == versions["a"] and now["b"] != versions["b"]  # a season without changes keeps its version
