"""Serving queries: latest rows, snapshots, impacts, lookups and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_EXPLANATION = "No standout component"


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (nulls first)."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order)))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def top_components(rows: DataFrame, labels: dict[str, str], n: int = 2, name: str = "explanation") -> DataFrame:
    """Adds the labels of the ``n`` columns that are largest by absolute value, nulls skipped, with a default text; equals keep the given order."""
    items = [F.when(F.col(c).isNotNull(), F.struct((-F.abs(c)).alias("size"), F.lit(k).alias("at"), F.lit(text).alias("label"))) for k, (c, text) in enumerate(labels.items())]
    best = F.slice(F.array_sort(F.array_compact(F.array(*items))), 1, n)
    text = F.array_join(F.transform(best, lambda x: x["label"]), " · ")
    return rows.withColumn(name, F.when(text != "", text).otherwise(DEFAULT_EXPLANATION))


def player_snapshot(ratings: DataFrame, mapping: DataFrame, valuations: DataFrame, predictions: DataFrame) -> DataFrame:
    """Latest rating of mapped players with latest value and prediction; direction and confidence follow from the probability of a rise."""
    rated = latest_per_key(ratings, ["player_id"], ["match_date", "match_id"])
    value = latest_per_key(valuations, ["player_id"], ["valuation_date"]).select("player_id", "market_value", "valuation_date")
    p = F.col("p_increase")
    rows = rated.join(mapping.select("player_id").distinct(), "player_id").join(value, "player_id", "left").join(predictions, "player_id", "left")
    direction = F.when(p >= 0.60, "rising").when(p <= 0.40, "falling").when(p.isNotNull(), "stable")
    return rows.withColumns({"direction": direction, "confidence": F.when(p.isNotNull(), F.greatest(p, 1 - p))})


def valuation_history_semi(valuations: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Valuations of the players in the snapshot."""
    return valuations.join(snapshot.select("player_id"), "player_id", "left_semi")


def match_impacts(ratings: DataFrame) -> DataFrame:
    """Adds ``impact`` (rating less six) and its label."""
    r = F.col("rating")
    return ratings.withColumns({"impact": r - 6, "impact_label": F.when(r > 6.25, "positive").when(r < 5.75, "negative").when(r.isNotNull(), "neutral")})


def publish_update_join(target: DataFrame, results: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` overwritten in rows whose key is in ``results``; a matched null overwrites too."""
    new = results.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_hit")).dropDuplicates(keys)
    rows = target.join(new, keys, "left")
    return rows.withColumns({c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}).select(*target.columns)


def lateral_top1(players: DataFrame, forms: DataFrame, values: DataFrame) -> DataFrame:
    """Players with their newest form (by date, then match) and value, by lateral subqueries.

    The newest row is the largest by its date, an aggregate: the order of a lateral subquery with a limit is lost when it sorts by a column that it does not select.
    """
    spark = players.sparkSession
    return spark.sql(
        """SELECT p.player_id, f.top.rating AS newest_rating, f.top.match_id AS newest_match, v.top.market_value AS newest_value
        FROM {players} p
        LEFT JOIN LATERAL (SELECT max(struct(match_date, match_id, rating)) AS top FROM {forms} x WHERE x.player_id = p.player_id) f
        LEFT JOIN LATERAL (SELECT max(struct(valuation_date, market_value)) AS top FROM {values} y WHERE y.player_id = p.player_id) v""",
        players=players, forms=forms, values=values,
    )


def player_detail(ratings: DataFrame, player_id: int, n: int = 20) -> DataFrame:
    """One player's last ``n`` rated matches of the newest rating version, oldest first, with impact and place in the sequence."""
    rows = ratings.where((F.col("player_id") == player_id) & F.col("rating").isNotNull())
    newest = rows.agg(F.max("rating_version").alias("_v"))
    order = [F.col("match_date").desc(), F.col("match_id").desc()]
    recent = rows.crossJoin(newest).where(F.col("rating_version") == F.col("_v")).drop("_v").orderBy(*order).limit(n)  # one row joins, one player's rows are sorted
    return match_impacts(recent).withColumn("sequence", F.row_number().over(Window.partitionBy("player_id").orderBy("match_date", "match_id")).cast("long"))


def recent_runs(runs: DataFrame, n: int) -> DataFrame:
    """The newest runs, between 1 and 100 of them."""
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(min(max(n, 1), 100))


def name_search(players: DataFrame, query: str, column: str = "player_name") -> DataFrame:
    """Rows whose name contains ``query``, whatever the case."""
    return players.where(F.lower(column).contains(query.lower().strip()))


def run_rollup(items: DataFrame, by: list[str]) -> DataFrame:
    """Outcome counts by status prefix, and the status of the whole: succeeded, partial or failed."""
    s = F.col("status")
    counts = items.groupBy(*by).agg(
        F.count("*").alias("items"), F.count_if(s.startswith("processed")).alias("processed"), F.count_if(s.startswith("skipped")).alias("skipped"), F.count_if(s.startswith("failed")).alias("failed")
    )
    status = F.when(F.col("failed") == 0, "succeeded").when(F.col("processed") + F.col("skipped") > 0, "partial").otherwise("failed")
    return counts.withColumn("run_status", status)


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], digest: str | None = None, order: list[str] | None = None) -> DataFrame:
    """``target`` after an upsert by key: rows of ``source`` replace those with the same key or are added.

    Of repeated source keys one row counts, the last by ``order`` or else the first by all columns. With ``digest`` rows whose digest is unchanged stay as they are. Applying the same source again changes nothing.
    """
    cols = target.columns
    rest = [c for c in source.columns if c not in keys]
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order or ()), *rest))
    new = source.withColumn("_n", n).where("_n = 1").select(*cols)
    if digest:
        same = target.select(*keys, F.col(digest).alias("_was"))
        new = new.join(same, keys, "left").where(~F.col(digest).eqNullSafe(F.col("_was")) | F.col("_was").isNull()).select(*cols)
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)
