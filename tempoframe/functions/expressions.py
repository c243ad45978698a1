"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Layers = Sequence[Mapping[str, str]]


def clip(value: Column | str, low: float, high: float) -> Column:
    """``value`` held within bounds; null stays null."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c.isNotNull(), F.greatest(F.lit(float(low)), F.least(c.cast("double"), F.lit(float(high)))))


def finite(value: Column) -> Column:
    """``value`` as double; null, NaN and infinities become zero."""
    v = value.cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)


def layered(df: DataFrame, layers: Layers) -> DataFrame:
    """Adds columns layer by layer; an expression sees the input and all earlier layers."""
    for layer in layers:
        df = df.withColumns({name: F.expr(e) for name, e in layer.items()})
    return df


def layered_sql(source: str, layers: Layers) -> str:
    """``layered`` as nested SQL over a table name or a parenthesised query."""
    for k, layer in enumerate(layers):
        known = f"(SELECT * FROM {source})" if k == 0 else source
        source = f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in layer.items())} FROM {known} AS l{k})"
    return source


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison, halves up, without negative zero."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(F.col(c) + 1e-10, places) + F.lit(0.0) for c in doubles}) if doubles else df


def rounded_sql(sql: str, doubles: Sequence[str], places: int = 6) -> str:
    """The same for a query; ``doubles`` names its double columns."""
    parts = ", ".join(f"round({c} + 1e-10::DOUBLE, {places}) + 0.0::DOUBLE AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({parts}) FROM ({sql}) AS r" if doubles else sql


def non_null_sum(value: Column | str) -> Column:
    """Sum that is zero where there are no values."""
    return F.coalesce(F.sum(value), F.lit(0))
