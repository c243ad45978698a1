"""The entry module: names, oracles and the flagship query."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql.classic.dataframe import DataFrame

import __spark_entry__
from tempoframe.plans import fixtures, registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 5)
    return value


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def compared(spark, name, sql):
    """Rows of a query and of its SQL, with columns in the same order."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = __spark_entry__.queries()[name](spark, SF), con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    rows = sorted(repr([plain(r[i]) for i in order]) for r in want.fetchall())
    return sorted(repr([plain(v) for v in r]) for r in got.collect()), rows


#: Steps of ``rating_adjustments`` and ``materialize``, which are compared as wholes; each of them takes as long.
STEPS = {"composite_restandardize", "goalkeeper_rating", "outfield_rating", "per90_log_features", "position_composite", "rating_components", "zscore_apply", "zscore_fit"}


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - STEPS))
def test_query_equals_its_sql(spark, name):
    got, want = compared(spark, name, registry.oracle_sql()[name])
    assert got == want


#: Queries whose players or matches are dealt into parts as the tables grow.
DEALT = ("input_signature_skip", "changed_partitions", "ratings_prepare", "valuation_intervals", "rolling_asof_form", "interval_performance", "interval_asof_join", "valuation_feature_table", "late_row_route", "incremental_rating_update")


@pytest.mark.parametrize("name", DEALT)
def test_parts_grow_with_the_tables(spark, monkeypatch, name):
    """Of small parts there are many, more than adaptive execution makes, and the result is that of the SQL."""
    monkeypatch.setattr(fixtures, "PART_ROWS", 500)
    assert fixtures.parts(spark, SF) == 12
    asked = []
    monkeypatch.setattr(DataFrame, "repartition", lambda df, n, *keys, real=DataFrame.repartition: asked.append(n) or real(df, n, *keys))
    got, want = compared(spark, name, registry.oracle_sql()[name])
    assert got == want and 12 in asked
