"""All queries of the event and valuation engine, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tempoframe.plans import events, features, files, fitting, forms, increments, ingestion, modelling, players, publishing

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (events, features, players, forms, publishing, ingestion, modelling, increments, fitting, files)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query that ``entry`` runs."""
    return events.left_join_aggregates(spark, sf_dir)


def queries() -> dict[str, Query]:
    """Queries by name."""
    return {f.__name__: f for m in MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by the name of its query."""
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
