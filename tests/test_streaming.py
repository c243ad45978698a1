"""Streams that stop, go on and repeat."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from tempoframe.operators.form import form_state
from tempoframe.streaming import tables

SCHEMA = "player_id long, match_id long, match_date date, minutes double, rating double"


def arrivals(seed, days, players=12):
    rng = random.Random(seed)
    return [(rng.randrange(players), seed * 1000 + k, dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(*days)), float(rng.choice([0, 45, 90])), rng.random() * 9) for k in range(60)]


def flat(df):
    return sorted((r.player_id, round(r.ewm_numerator, 6), round(r.ewm_denominator, 6), r.last_match_date, [x.match_id for x in r.recent]) for r in df.collect())


def written_since(folder, moment):
    """Bytes of the state files that are newer."""
    files = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names]
    return sum(os.path.getsize(f) for f in files if os.path.getmtime(f) > moment and "/state/" in f)


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, root, late = (f"file://{tmp_path}/{n}" for n in ("in", "state", "late"))
    parts = [arrivals(1, (0, 30)), [*arrivals(2, (30, 60), 20), (3, 8, dt.date(2024, 2, 29), None, 5.0), (4, 9, dt.date(2024, 2, 29), 90.0, None)], arrivals(3, (60, 90), 3)]
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(source)
        got = tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root, late)
        want = form_state(spark.createDataFrame([r for p in parts[: k + 1] for r in p], SCHEMA))
        assert flat(got) == flat(want)
    assert flat(tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root, late)) == flat(want)  # nothing new
    old = [(0, 9, dt.date(2023, 1, 1), 90.0, 5.0), (0, 10, None, 90.0, 5.0), (99, 11, dt.date(2023, 1, 1), 90.0, 5.0), (None, 12, dt.date(2024, 5, 1), 90.0, 5.0)]
    spark.createDataFrame(old, SCHEMA).write.mode("append").parquet(source)
    after = flat(tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root, late))
    assert [r for r in after if r[0] != 99] == flat(want) and len(after) == len(flat(want)) + 1  # a new player is never late
    assert sorted(r.match_id for r in spark.read.parquet(late).collect()) == [9, 10]


def test_a_batch_writes_what_its_keys_need(spark, tmp_path):
    """Five keys among thousands: the batch's state files are a small part of the first one's."""
    rng = random.Random(1)
    source, root = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    first = [(p, p * 100 + k, dt.date(2024, 1, 1) + dt.timedelta(days=k), 90.0, rng.random() * 9) for p in range(3000) for k in range(5)]
    spark.createDataFrame(first, SCHEMA).write.parquet(source)
    tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root)
    whole = written_since(tmp_path / "state", 0)
    moment = max(os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(tmp_path / "state") for f in names)
    spark.createDataFrame([(p, 10**7 + p, dt.date(2024, 3, 1), 90.0, 5.0) for p in range(5)], SCHEMA).write.mode("append").parquet(source)
    got = tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root)
    assert got.count() == 3000
    part = written_since(tmp_path / "state", moment)
    assert 0 < part < whole / 20, (part, whole)


def test_upserts_by_key(spark, tmp_path):
    source, root, changes = (f"file://{tmp_path}/{n}" for n in ("in", "state", "changes"))
    schema = "k long, part string, v long, h string, at long"
    read = lambda: sorted(map(tuple, tables.stream_upsert(tables.file_stream(spark, source, schema), ["k", "part"], "h", root, "at", changes).collect()))
    spark.createDataFrame([(1, "a", 5, "x", 1), (1, "a", 9, "z", 0), (2, None, None, "x", 1), (3, "c", 1, "x", 1)], schema).coalesce(1).write.parquet(source)
    assert read() == sorted([(1, "a", 5, "x", 1), (3, "c", 1, "x", 1), (2, None, None, "x", 1)])  # the later by ``at`` counts
    spark.createDataFrame([(1, "a", 6, "x", 2), (3, "c", 2, "y", 2), (4, "d", 2**53 + 1, None, 1)], schema).coalesce(1).write.mode("append").parquet(source)
    assert read() == sorted([(1, "a", 5, "x", 1), (2, None, None, "x", 1), (3, "c", 2, "y", 2), (4, "d", 2**53 + 1, None, 1)])  # the same digest: left as it was
    assert sorted(r.k for r in spark.read.parquet(f"{changes}/batch=1").collect()) == [3, 4]


def test_upserts_without_a_digest_stay_out_of_python(spark, tmp_path, monkeypatch):
    """The last row of a key by batch, then by ``order``, then by all columns; also after a batch that ran twice, and with the rows that a batch wrote."""
    monkeypatch.setattr(tables, "UpsertProcessor", None)
    source, root, changes = (f"file://{tmp_path}/{n}" for n in ("in", "state", "changes"))
    schema = "k long, part string, v double, at long"
    read = lambda: sorted(map(tuple, tables.stream_upsert(tables.file_stream(spark, source, schema), ["k", "part"], None, root, "at", changes).collect()))
    spark.createDataFrame([(1, "a", 5.0, 1), (1, "a", 9.0, 0), (2, None, None, None), (2, None, 1.0, None), (3, "c", 1.0, 1)], schema).write.parquet(source)
    assert read() == [(1, "a", 5.0, 1), (2, None, 1.0, None), (3, "c", 1.0, 1)]
    spark.createDataFrame([(1, "a", 2.0, 0), (3, "c", None, None), (4, "d", 0.5, 1)], schema).write.mode("append").parquet(source)
    want = [(1, "a", 2.0, 0), (2, None, 1.0, None), (3, "c", None, None), (4, "d", 0.5, 1)]  # a later batch counts, whatever its ``order``
    assert read() == want
    for name in ("1", ".1.crc"):
        os.remove(tmp_path / "state" / "commits" / name)
    assert read() == want
    assert sorted(r.k for r in spark.read.parquet(f"{changes}/batch=1").collect()) == [1, 3, 4]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """A failure after the sink and before the commit: the batch runs again from the states that it found."""
    source, root = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    for k in range(2):
        spark.createDataFrame(arrivals(4 + k, (30 * k, 30 * k + 30)), SCHEMA).write.mode("append").parquet(source)
        want = flat(tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root))
    for name in ("1", ".1.crc"):
        os.remove(tmp_path / "state" / "commits" / name)
    assert flat(tables.stream_form_state(tables.file_stream(spark, source, SCHEMA), root)) == want


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"file://{tmp_path}/in")
    assert tables.stream_form_state(tables.file_stream(spark, f"file://{tmp_path}/in", SCHEMA), f"file://{tmp_path}/state").count() == 0
