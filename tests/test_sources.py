"""Files: strict lines, hashes, keyed tables and walked payloads."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tempoframe.functions.nested import walk_raw_events
from tempoframe.functions.state import written as nes_written
from tempoframe.sources import files as src


@pytest.mark.parametrize("block", ["100", "1000", "128m"])
def test_the_first_bad_line_is_named(spark, tmp_path, block):
    """For whatever blocks a file is read in."""
    good = [json.dumps({"a": i, "b": "x" * (i % 30)}) for i in range(200)]
    (tmp_path / "one.jsonl").write_text("\n".join(good) + "\n")
    bad = list(good)
    bad[50], bad[120], bad[151], bad[160] = "", "[1, 2]", '{"a": 1', "  \r"
    (tmp_path / "two.jsonl").write_text("\n".join(bad) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        found = sorted((r.file.rsplit("/", 1)[1], r.line, r.text) for r in src.jsonl_faults(spark, str(tmp_path), "a long, b string").collect())
        assert found == [("two.jsonl", 121, "[1, 2]"), ("two.jsonl", 152, '{"a": 1')]
        with pytest.raises(ValueError, match=r"two\.jsonl, line 121"):
            src.scan_jsonl_strict(spark, str(tmp_path), "a long, b string")
        rows = src.scan_jsonl_strict(spark, str(tmp_path / "one.jsonl"), "a long, b string").collect()
        assert sorted(r.a for r in rows) == list(range(200))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_an_edited_byte_changes_its_group(spark, tmp_path):
    texts = {("g1", "a"): b"one\x00", ("g1", "b"): b"\n", ("g2", "c"): bytes(range(256)) * 5000}
    for (g, n), raw in texts.items():
        (tmp_path / g).mkdir(exist_ok=True)
        (tmp_path / g / f"{n}.bin").write_bytes(raw)
    read = lambda: {r.group: (r.signature, r.files) for r in src.hash_files(spark, str(tmp_path), r"/(\w+)\.bin$", r"/(g\d)/").collect()}
    digest = lambda *names: hashlib.sha256("\n".join(f"{n}:{hashlib.sha256(texts[k]).hexdigest()}" for k in names for n in [k[1]]).encode()).hexdigest()
    first = read()
    assert first == {"g1": (digest(("g1", "a"), ("g1", "b")), 2), "g2": (digest(("g2", "c")), 1)}
    raw = bytearray(texts[("g2", "c")])
    raw[70_000] ^= 1
    (tmp_path / "g2" / "c.bin").write_bytes(bytes(raw))
    second = read()
    assert second["g1"] == first["g1"] and second["g2"] != first["g2"]


def test_an_upsert_writes_the_parts_that_it_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(src, "PART_ROWS", 100)
    path, schema = f"file://{tmp_path}/t", "k long, v string, at int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert tuple(src.sink_keyed_upsert(frame([(i, f"v{i}", 0) for i in range(1000)]), path, ["k"]).first()) == (1000, 0, 0, 10)
    kept = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    done = src.sink_keyed_upsert(frame([(5, "new", 1), (5, "older", 0), (6, "v6", 0), (2000, None, 0)]), path, ["k"], order=["at"]).first()
    assert tuple(done)[:3] == (1, 1, 1) and 1 <= done["parts_written"] <= 2
    left = [f for f, t in kept.items() if f.exists() and f.stat().st_mtime_ns == t]
    assert len(left) >= 8
    want = {i: (f"v{i}", 0) for i in range(1000)} | {5: ("new", 1), 2000: (None, 0)}
    assert {r.k: (r.v, r["at"]) for r in src.keyed_table(spark, path).collect()} == want
    assert tuple(src.sink_keyed_upsert(frame([(5, "new", 1), (2000, None, 0)]), path, ["k"]).first()) == (0, 0, 2, 0)


def event_objects(value, path="$"):
    """The same by recursion."""
    if isinstance(value, dict):
        if ("id" in value or "eventId" in value) and "minute" in value and isinstance(value.get("type"), dict):
            yield path
        for k, v in value.items():
            yield from event_objects(v, f"{path}.{k}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from event_objects(v, f"{path}[{i}]")


def nested(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.2:
        return rng.choice([1, 2.5, "x{", None, True, [], {}])
    if kind < 0.5:
        return [nested(rng, depth - 1) for _ in range(rng.randrange(4))]
    found = {k: nested(rng, depth - 1) for k in rng.sample(["id", "eventId", "minute", "type", "a", "b"], rng.randrange(1, 6))}
    if rng.random() < 0.5:
        found |= {"id": None, "minute": 3, "type": {"value": 1}}
    return found


def test_payloads_are_walked(spark):
    rng = random.Random(3)
    payloads = [(i, json.dumps(nested(rng, 6))) for i in range(60)] + [(100, None), (101, "no json"), (102, ""), (103, "[]")]
    df = walk_raw_events(spark.createDataFrame(payloads, "match_id long, payload string"))
    want = sorted((i, p) for i, t in payloads if t and t != "no json" for p in event_objects(json.loads(t)))
    assert len(want) > 40
    assert sorted((r.match_id, r.json_path) for r in df.collect()) == want
    assert "Python" not in df._jdf.queryExecution().toString()
    assert walk_raw_events(spark.createDataFrame([], "match_id long, payload string")).count() == 0


def test_a_walk_writes_events_and_not_payloads(spark, monkeypatch):
    from tempoframe.functions import nested as nes

    kept = []
    monkeypatch.setattr(nes, "written", lambda df, name: kept.append(nes_written(df, name)) or kept[-1])
    event = {"id": 1, "minute": 2, "type": {"value": 3, "more": {"deep": [{"x": 1}]}}}
    payloads = [(k, json.dumps({"home": {"incidents": [event] * 5}, "events": [event] * 200})) for k in range(3)]
    found = walk_raw_events(spark.createDataFrame(payloads, "match_id long, payload string"))
    assert found.count() == 3 * 205
    sizes = [max((len(json.dumps(json.loads(v))) for r in df.selectExpr("to_json(v) AS v").collect() if (v := r.v)), default=0) for df in kept]
    assert max(sizes) < 1000 and sum(df.count() for df in kept) == 3 * 205


def test_long_texts_reach_python_in_small_batches(spark):
    from tempoframe.functions.nested import extract_embedded_json
    from tempoframe.functions.text import normalize_name

    rows = spark.createDataFrame([('<a> d = {"a": "}"}; x', "Ä b"), (None, None), ("d = {", "")], "html string, name string")
    made = extract_embedded_json(rows, "d = ").withColumn("k", normalize_name("name"))
    assert [(r.payload, r.k) for r in made.collect()] == [('{"a": "}"}', "a b"), (None, None), (None, "")]
    assert "ArrowEvalPython" not in made._jdf.queryExecution().executedPlan().toString()


def test_asof_join_by_buckets(spark):
    from tempoframe.operators import valuation as val

    rng = random.Random(8)
    day = lambda: F.date_add(F.lit("2020-01-01"), rng.randrange(900))
    ratings = spark.createDataFrame([(rng.randrange(4), k, rng.randrange(900), 90.0, 6.0) for k in range(300)], "player_id long, match_id long, d int, minutes double, rating double")
    ratings = ratings.withColumn("match_date", F.expr("date_add(date'2020-01-01', d)"))
    intervals = spark.createDataFrame([(p, rng.randrange(900)) for p in range(5) for _ in range(12)], "player_id long, d int").distinct()
    intervals = intervals.withColumns({"valuation_date": F.expr("date_add(date'2020-01-01', d)"), "previous_valuation_date": F.expr("date_add(date'2020-01-01', d - 30)")})
    got = val.interval_asof_join(intervals, ratings, bucket_days=37)
    rows, asked = ratings.collect(), intervals.collect()
    want = []
    for i in asked:
        before = sorted([r for r in rows if r.player_id == i.player_id and r.match_date < i.valuation_date], key=lambda r: (r.match_date, r.match_id), reverse=True)
        want += [(i.player_id, i.valuation_date, r.match_id, k, (i.valuation_date - r.match_date).days) for k, r in enumerate(before, 1)]
    assert sorted((r.player_id, r.valuation_date, r.match_id, r.recency_rank, r.days_before) for r in got.collect()) == sorted(want)
