"""Matching entities of two sources by name, with overrides and a review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collect_entities(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """One row per player: most frequent name (the first by name among equals), latest known team and position, appearances, and the name's key."""
    name = F.mode("player_name", True)
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("match_date", "match_id")))
    made = rows.where("player_id is not null").groupBy("player_id").agg(
        name.alias("player_name"), latest("team_id").alias("team_id"), latest("position").alias("position"), F.count("*").alias("appearances")
    )
    return made.withColumn("name_key", F.trim(F.regexp_replace(F.lower("player_name"), "[^a-z0-9]+", " ")) if key is None else key)


def override_match(left: DataFrame, right: DataFrame, overrides: DataFrame) -> DataFrame:
    """Approved pairs with confidence 1; an unknown id on either side raises an error when it is read."""
    pairs = overrides.select("player_id", "candidate_id").dropna().distinct()
    known = pairs.join(left.select("player_id", F.lit(1).alias("_l")).distinct(), "player_id", "left").join(
        right.select("candidate_id", F.lit(1).alias("_r")).distinct(), "candidate_id", "left"
    )
    lost = F.col("_l").isNull() | F.col("_r").isNull()
    method = F.when(lost, F.raise_error(F.lit("an override names an unknown id")).cast("string")).otherwise(F.lit("override"))
    return known.select("player_id", "candidate_id", method.alias("method"), F.lit(1.0).alias("confidence"))


def exact_unique_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs whose key occurs once on either side, with confidence 0.95; null and empty keys match nothing."""
    def once(df: DataFrame) -> DataFrame:
        return df.where("name_key <> ''").withColumn("_n", F.count("*").over(Window.partitionBy("name_key"))).where("_n = 1")

    pairs = once(left).select("player_id", "name_key").join(once(right).select("candidate_id", "name_key"), "name_key")
    return pairs.select("player_id", "candidate_id", F.lit("exact_name").alias("method"), F.lit(0.95).alias("confidence"))


def match_entities(left: DataFrame, right: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overrides first; their ids leave both sides before exact matches are made."""
    fixed = override_match(left, right, overrides)
    rest = exact_unique_match(
        left.join(fixed.select("player_id"), "player_id", "left_anti"), right.join(fixed.select("candidate_id"), "candidate_id", "left_anti")
    )
    return fixed.unionByName(rest)


def review_queue(left: DataFrame, right: DataFrame, matched: DataFrame) -> DataFrame:
    """Unmatched rows of ``left`` with the unused candidates of the same key and why they are here."""
    free = right.join(matched.select("candidate_id"), "candidate_id", "left_anti")
    lists = free.groupBy("name_key").agg(F.sort_array(F.collect_list("candidate_id")).alias("candidate_ids"))
    rows = left.join(matched.select("player_id"), "player_id", "left_anti").join(lists, "name_key", "left")
    n = F.coalesce(F.size("candidate_ids"), F.lit(0))
    return rows.select("player_id", "name_key", F.greatest(n, F.lit(0)).cast("long").alias("candidates"), "candidate_ids", F.when(n > 0, "ambiguous").otherwise("none").alias("reason"))


def assert_one_to_one(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Different pairs without nulls; an id with two partners raises an error when it is read."""
    rows = pairs.select(a, b).dropna().distinct()
    many = (F.count("*").over(Window.partitionBy(a)) > 1) | (F.count("*").over(Window.partitionBy(b)) > 1)
    kind = rows.schema[a].dataType
    checked = F.when(F.col("_many"), F.raise_error(F.lit(f"{a} and {b} are not one to one")).cast(kind)).otherwise(F.col(a))
    return rows.withColumn("_many", many).select(checked.alias(a), b)
