"""Ratings of seasons kept below a path and brought up to date by what has changed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.state import written
from tempoframe.operators.form import HALF_LIFE, changed_partitions
from tempoframe.operators.ledger import _FORM, _ROW, advanced, edits_between, form_ledger
from tempoframe.operators.moments import match_digests, pass_moments, prior_from, replaced, season_versions
from tempoframe.operators.ratings import fitted_ratings
from tempoframe.sources.files import sink_partition_overwrite

_KEPT = (*_ROW, *_FORM, "season")


def stored(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table of the kept state: ``ratings`` (with form), ``digests``, ``versions``, ``priors``, ``stats``, ``pass_moments``; None before the first update."""
    try:
        return spark.read.parquet(f"{path}/{name}")
    except AnalysisException:
        return None


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    table = stored(spark, path, "ledger")
    return None if table is None else table.where(F.col("run") == table.agg(F.max("run")).first()[0]).drop("run")


def _season_rows(rated: DataFrame) -> DataFrame:
    return rated.select("player_id", "match_id", "match_date", F.col("minutes").cast("double").alias("minutes"), F.col("post_match_rating").alias("rating"), "season")


def update_ratings(features: DataFrame, path: str, half_life: float = HALF_LIFE) -> DataFrame:
    """Brings the ratings below ``path`` up to date with ``features`` (player-match rows with ``season`` and ``match_date``) and returns what was done, one row.

    A match is known by the digest of its rows. Without changes everything is reused. A season in which a known match has changed, or which is new, is fitted
    again: priors from the stored moments with the changed matches' replaced, statistics and ratings from its rows. New matches of other seasons are rated with the
    frozen priors and statistics. Rated rows that differ from the stored ones are edits of form: players whose rows follow their state
    go on from it, others are computed again, and states take the edits in. ``route`` is 'fit', 'refit', 'recompute', 'append' or 'reuse'. Only seasons that
    hold a changed row are written; a season without changed matches keeps its ``version``. An update that failed leaves the digests as they
    were, so that the next one finds the same changes.
    """
    spark = features.sparkSession
    old = stored(spark, path, "digests")
    digests = written(match_digests(features), "digests")
    known = digests.limit(0) if old is None else written(old.select("match_id", "input_hash", "season"), "known")
    changes = written(changed_partitions(digests, known, "match_id").join(digests.select("match_id", "season"), "match_id"), "changes")
    fitted = set() if old is None else {r[0] for r in stored(spark, path, "versions").select("season").collect()}  # seasons are few
    found = changes.groupBy("season").agg(F.count_if(F.col("status") == "changed").alias("changed"), F.count_if(F.col("status") == "new").alias("new")).collect()
    again = [r["season"] for r in found if r["changed"] or r["season"] not in fitted]
    counts = (sum(r["new"] for r in found), sum(r["changed"] for r in found))
    shape = "route string, new_matches long, changed_matches long, recomputed_players long, fitted_seasons long"
    if not found:
        return spark.createDataFrame([("reuse", 0, 0, 0, 0)], shape)

    moved = features.join(changes.select("match_id"), "match_id", "left_semi")
    sums, rated = pass_moments(moved), None
    if old is not None:
        before = stored(spark, path, "pass_moments").where(F.col("season").isin([r["season"] for r in found]))
        sums = replaced(before.select(*sums.columns), sums)
    sums = written(sums, "pass-moments")
    if again:
        rated, priors, stats = fitted_ratings(features.where(F.col("season").isin(again)), written(prior_from(sums.where(F.col("season").isin(again))), "priors"))
        rated = _season_rows(rated)
        for name, table in (("priors", priors), ("stats", stats)):
            sink_partition_overwrite(table, f"{path}/{name}", ["season"])
    fresh = moved if not again else moved.where(~F.col("season").isin(again))
    if len(found) > len(again):
        frozen = _season_rows(fitted_ratings(fresh, stored(spark, path, "priors"), stored(spark, path, "stats"))[0])
        rated = frozen if rated is None else rated.unionByName(frozen)
    rated = written(rated, "rated")
    if old is None:
        ledger, history = form_ledger(rated.limit(0), half_life), rated.withColumns({c: F.lit(None).cast("double") for c in _FORM}).limit(0)
    else:
        ledger, history = _ledger(spark, path), stored(spark, path, "ratings").select(*_KEPT)
    # A season that is fitted again changes the ratings of all its matches.
    matches = rated.select("match_id").distinct()
    edits = edits_between(history, rated, matches, ("season",))
    after, states, routes = advanced(history, ledger, edits, half_life)
    routes = written(routes, "routes")
    late = routes.where("route = 'recompute'").select("player_id")
    recomputed = late.count()
    touched = after.join(late, "player_id", "left_semi").select("season").union(rated.select("season")).distinct()
    seasons = [r[0] for r in touched.collect()]
    sink_partition_overwrite(after.where(F.col("season").isin(seasons)), f"{path}/ratings", ["season"])
    table = stored(spark, path, "ledger")
    run = 0 if table is None else table.agg(F.max("run")).first()[0] + 1
    states.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{path}/ledger")
    now = digests.where(F.col("season").isin([r["season"] for r in found]))
    sink_partition_overwrite(sums, f"{path}/pass_moments", ["season"])
    sink_partition_overwrite(season_versions(now), f"{path}/versions", ["season"])
    sink_partition_overwrite(now, f"{path}/digests", ["season"])  # last: what was not finished is found changed again
    route = "fit" if old is None else "refit" if again else "recompute" if recomputed else "append"
    return spark.createDataFrame([(route, *counts, recomputed, len(again))], shape)
