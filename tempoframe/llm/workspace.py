"""Tables of the training-data operators: the given ones, those in the shared folder, and joins that a common key does not load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempoframe.functions.state import shared_path as new_path
from tempoframe.functions.state import written as staged

__all__ = ["best_rows", "join_counted", "new_path", "staged", "table", "width"]

#: Keys of at least this many rows can be hot, and at most this many keys are: both bound what a hot key costs.
HOT_ROWS, MAX_HOT = 1_000, 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], copies: str = "copies", total: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, which has one row a key and in ``copies`` how many of ``rows`` have it (``total`` together).

    A key of more than ``HOT_ROWS`` rows and more than a ``MAX_HOT``-th of all would fill one task; there are at most
    ``MAX_HOT`` such keys, so they are broadcast, and only the rows of other keys are shuffled.
    """
    known = total is not None
    total = total if known else keyed.agg(F.sum(copies)).first()[0] or 0
    least = max(HOT_ROWS, total // MAX_HOT)
    hot = F.broadcast(keyed.where(F.col(copies) > least))
    if total <= least or (not known and hot.isEmpty()):
        return rows.join(keyed, on)
    rest = rows.join(hot.select(*on), on, "left_anti").join(keyed.where(F.col(copies) <= least), on)
    return rows.join(hot, on).unionByName(rest)


#: Parts in which the rows of one key are ranked first.
_RANKED = 32


def best_rows(rows: DataFrame, keys: list[str], order: list[Column], k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their place (an int from 1) in the column ``name``.

    Every task and then every part of a key drops what cannot be among them, so that few rows of a key meet in one place.
    """
    part = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys]), F.lit(_RANKED))
    place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    first = rows.withColumn("_part", part).withColumn(name, place).where(F.col(name) <= k).drop("_part", name)
    return first.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
