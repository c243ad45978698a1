"""Rating statistics as moments by match: merged exactly, replaced match by match, versioned by season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempoframe.functions.expressions import clip, finite
from tempoframe.operators.ratings import FEATURES, GROUP, KEEPER_FEATURES, OUTFIELD


def _moments(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    v = F.col(value)
    return rows.groupBy(*by).agg(F.count(v).alias("n"), F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("m2"))


def merged(moments: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean and sum of squared deviations (``n``, ``mean``, ``m2``) of the union of parts, by Chan's rule: squares are taken around the common mean, not around zero."""
    whole = moments.groupBy(*by).agg(F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_mean"))
    joined = moments.join(F.broadcast(whole), by)  # a row for each season, position and feature
    apart = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    return joined.groupBy(*by).agg(F.first("_n").alias("n"), F.coalesce(F.first("_mean"), F.lit(0.0)).alias("mean"), F.coalesce(F.sum(apart), F.lit(0.0)).alias("m2"))


def replaced(moments: DataFrame, new: DataFrame) -> DataFrame:
    """``moments`` with the matches of ``new`` replaced by it or added."""
    return moments.join(new.select("season", "match_id").distinct(), ["season", "match_id"], "left_anti").unionByName(new)


def feature_moments(features: DataFrame, outfield: tuple[str, ...] = FEATURES) -> DataFrame:
    """Moments of every feature by season, position and match. ``faced`` tells goalkeepers' rows with shots on target faced, which alone count if a group has any."""
    faced = F.coalesce((F.col("position_group") == "Goalkeeper") & (finite(F.col("shots_on_target_faced")) > 0), F.lit(False))
    rows = features.where(F.col("position_group").isin(*OUTFIELD, "Goalkeeper")).withColumn("faced", faced)
    keeper = F.col("position_group") == "Goalkeeper"
    parts = []
    for names, which in ((outfield, ~keeper), (KEEPER_FEATURES, keeper)):
        pairs = F.array(*(F.struct(F.lit(f).alias("feature"), finite(F.col(f)).alias("value")) for f in names))
        parts.append(rows.where(which).select(*GROUP, "match_id", "faced", F.inline(pairs)))
    return _moments(parts[0].unionByName(parts[1]), [*GROUP, "match_id", "faced", "feature"], "value")


def _chosen(moments: DataFrame, flag: str) -> DataFrame:
    """Rows with the flag, or all of a group that has none."""
    some = F.max(F.col(flag).cast("int")).over(Window.partitionBy(*GROUP)) == 1
    return moments.withColumn("_some", some).where(~F.col("_some") | F.col(flag)).drop("_some")


def zscore_from(moments: DataFrame) -> DataFrame:
    """``zscore_fit`` of the rows that the moments were taken of."""
    got = merged(_chosen(moments, "faced"), [*GROUP, "feature"])
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).otherwise(0.0)
    return got.select(*GROUP, "feature", "mean", F.when(deviation <= 1e-9, 1.0).otherwise(deviation).alias("std"), F.col("n").alias("sample_size"))


def pass_moments(features: DataFrame) -> DataFrame:
    """What the prior of pass completion is made of, by season, position and match; ``some`` tells rows of five passes or more."""
    t, d = finite(F.col("passes")), finite(F.col("completed_passes"))
    rows = features.where(F.col("position_group").isin(*OUTFIELD)).select(*GROUP, "match_id", t.alias("t"), d.alias("d"))
    rate = F.when(F.col("t") > 0, F.least(F.greatest(F.col("d") / F.col("t"), F.lit(0.0)), F.lit(1.0)))
    rows = rows.withColumns({"some": F.col("t") >= 5, "rate": rate, "inverse": F.when(F.col("t") > 0, 1 / F.col("t"))})
    by = [*GROUP, "match_id", "some"]
    sums = rows.groupBy(*by).agg(F.sum("t").alias("tried"), F.sum("d").alias("done"), F.count("*").alias("match_rows"), F.coalesce(F.sum("inverse"), F.lit(0.0)).alias("inverse"))
    return sums.join(_moments(rows, by, "rate"), by)


def prior_from(moments: DataFrame) -> DataFrame:
    """``pass_completion_prior`` of the rows that the moments were taken of."""
    used = _chosen(moments, "some")
    sums = used.groupBy(*GROUP).agg(F.sum("tried").alias("attempted_passes"), F.sum("done").alias("done"), F.sum("match_rows").alias("match_rows"), F.sum("inverse").alias("_inverse"))
    rows = sums.join(merged(used.select(*GROUP, "n", "mean", "m2"), GROUP), GROUP)
    rows = rows.withColumn("observed_variance", F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)).otherwise(0.0))
    rows = rows.withColumn("completed_passes", F.least("done", "attempted_passes"))
    p = F.when(F.col("attempted_passes") > 0, F.col("completed_passes") / F.col("attempted_passes")).otherwise(0.75)
    rows = rows.withColumn("pass_completion_prior", p)
    p = F.col("pass_completion_prior")
    rows = rows.withColumn("sampling_variance", p * (1 - p) * F.coalesce(F.try_divide(F.col("_inverse"), F.col("n")), F.lit(0.0)))
    rows = rows.withColumn("between_match_variance", clip(F.col("observed_variance") - F.col("sampling_variance"), 0.0025, 0.05))
    rows = rows.withColumn("prior_strength", clip(p * (1 - p) / F.col("between_match_variance") - 1, 5, 60))
    return rows.drop("done", "_inverse", "n", "mean", "m2")


def match_digests(rows: DataFrame) -> DataFrame:
    """``input_hash`` of each match of a season: a digest of all its rows in any order."""
    names = sorted(c for c in rows.columns if c not in ("season", "match_id"))
    each: Column = F.xxhash64(*names).cast("decimal(38,0)")
    total = F.concat_ws(":", F.sum(each).cast("string"), F.count("*").cast("string"), F.bit_xor(F.xxhash64(*names)).cast("string"))
    return rows.groupBy("season", "match_id").agg(F.md5(total.cast("binary")).alias("input_hash"))


def season_versions(digests: DataFrame) -> DataFrame:
    """``version`` of each season, which changes if and only if one of its matches does, and how many it has."""
    each = F.xxhash64("match_id", "input_hash")
    total = F.concat_ws(":", F.sum(each.cast("decimal(38,0)")).cast("string"), F.bit_xor(each).cast("string"))
    return digests.groupBy("season").agg(F.md5(total.cast("binary")).alias("version"), F.count("*").alias("matches"))
