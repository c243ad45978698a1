"""Filling and scaling as something that is fitted once, stored, and applied to any later table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.ranks import counted, quantiles


@dataclass(frozen=True)
class Preparation:
    """What columns were filled and scaled with: medians, then means and deviations of the filled values; and the levels of a position, if any."""

    columns: tuple[str, ...]
    medians: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    position: str | None = None
    levels: tuple[str, ...] = ()

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns filled, centred and scaled; a row's result depends on nothing but the row. Absent columns raise an error."""
        if missing := sorted({*self.columns, *([self.position] if self.position else [])} - set(rows.columns)):
            raise ValueError(f"rows lack columns: {missing}")
        made = {
            c: (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(a)) / F.lit(s)
            for c, m, a, s in zip(self.columns, self.medians, self.means, self.deviations, strict=True)
        }
        return rows.withColumns(made).select(*rows.columns)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Preparation:
        return Preparation(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})

    def save(self, spark: SparkSession, path: str) -> str:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preparation:
        return Preparation.from_json(spark.read.text(path).first()[0])


def fit_preparation(rows: DataFrame, columns: Sequence[str], position: str | None = None, levels_from: DataFrame | None = None) -> Preparation:
    """Medians, means and population deviations (one if zero) of ``columns`` over ``rows``; a column without values is filled with zero.

    Levels of ``position``, which are few, come from ``levels_from`` where that is given: labels of rows that are kept apart tell nothing of their targets.
    """
    columns = tuple(columns)
    middle = quantiles(rows, {c: (c, 0.5) for c in columns}).first()
    medians = tuple(float(middle[c]) if middle[c] is not None else 0.0 for c in columns)
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(columns, medians, strict=True)]
    got = rows.agg(*(F.avg(v) for v in filled), *(F.stddev_pop(v) for v in filled)).first()
    means = tuple(float(v or 0.0) for v in got[: len(columns)])
    deviations = tuple(float(v) if v else 1.0 for v in got[len(columns) :])
    levels = ()
    if position is not None:
        named = (rows if levels_from is None else levels_from).select(F.col(position).cast("string").alias("p")).where("p is not null").distinct()
        levels = tuple(sorted(r[0] for r in named.collect()))
    return Preparation(columns, medians, means, deviations, position, levels)


def fit_codes(rows: DataFrame, column: str) -> DataFrame:
    """Every level of ``column`` with its place ``code`` in their order, from 0; levels are dealt out by ranges, so there may be very many."""
    places = counted(rows.where(F.col(column).isNotNull()).select(column).distinct(), column)
    return places.select(column, F.col("start").alias("code"))


def apply_codes(rows: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Adds ``<column>_code``; a level that ``codes`` lacks, or null, gets their number."""
    unknown = F.broadcast(codes.agg(F.count("*").alias("_unknown")))  # one row
    joined = rows.join(codes.withColumnRenamed("code", "_code"), column, "left").crossJoin(unknown)
    return joined.withColumn(f"{column}_code", F.coalesce("_code", "_unknown")).select(*rows.columns, f"{column}_code")
