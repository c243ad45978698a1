"""Exact ranks and quantiles of any number of different values, range by range instead of in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempoframe.functions.state import written


def counted(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """Every different value (of each key) with its number of rows ``n`` and the number of rows before it in order, ``start``; null values are left out.

    Values are counted, dealt out by ranges and added up range by range; a row for each range is all that is summed in one place.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    parts = written(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "counts")
    sums = parts.groupBy(*keys, "_part").agg(F.sum("n").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_offset") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return parts.join(F.broadcast(offsets), [*keys, "_part"]).select(*keys, value, "n", start.cast("long").alias("start"))


def quantiles(rows: DataFrame, wanted: Mapping[str, tuple[str, float]], discrete: bool = False) -> DataFrame:
    """One row with the exact quantiles in ``wanted`` (name to column and share), null where a column has no values.

    Between two values they are interpolated, or, if ``discrete``, they are the first value at which the share is reached. All
    columns go through one pass.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    cells = [F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v")) for k, c in enumerate(columns)]
    places = counted(rows.select(F.inline(F.array(*cells))), "v", "k")
    totals = places.groupBy("k").agg(F.max(F.col("start") + F.col("n")).alias("total"))
    placed = places.join(F.broadcast(totals), "k")  # a row for each column
    made, out = [], []
    for name, (column, q) in wanted.items():
        mine = F.col("k") == columns.index(column)
        end = F.col("start") + F.col("n")
        if discrete:
            total = F.col("total")
            hit = mine & (end / total >= q) & ((F.col("start") / total < q) | (F.col("start") == 0))
            made.append(F.min(F.when(hit, F.col("v"))).alias(name))
            out.append(F.col(name))
            continue
        at = (F.col("total") - 1) * F.lit(float(q))
        low, high = F.floor(at), F.ceil(at)
        for end_name, rank in ((f"{name}_0", low), (f"{name}_1", high)):
            made.append(F.max(F.when(mine & (F.col("start") <= rank) & (rank < end), F.col("v"))).alias(end_name))
        made.append(F.max(F.when(mine, at - low)).alias(f"{name}_2"))
        a, b, part = (F.col(f"{name}_{i}") for i in range(3))
        out.append(F.when(part == 0, a).otherwise(a * (1 - part) + b * part).alias(name))
    return placed.agg(*made).select(*out)


def average_ranks(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the average rank (from 1) of equal values of ``column``; rows without a value are left out."""
    places = counted(rows, column)
    return rows.join(places.select(column, (F.col("start") + (F.col("n") + 1) / 2.0).alias(name)), column)
