"""Queries that take derived tables through files and streams, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.functions.state import shared_path
from tempoframe.plans.fixtures import ctes, projected, table
from tempoframe.plans.forms import ORACLES as FORMS
from tempoframe.plans.forms import _flat
from tempoframe.sources import files as src
from tempoframe.streaming import tables as stm

_CUTS = ("1997-01-01", "1999-01-01", "2100-01-01")


def scan_jsonl_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders from JSON lines."""
    path = shared_path(spark, "lines")
    src.sink_json_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), path)
    return src.scan_jsonl_strict(spark, path, "o_orderkey long, o_custkey long, o_orderpriority string")


def sink_json_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, exported as CSV and read back."""
    path = shared_path(spark, "csv")
    src.sink_json_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, "csv")
    return spark.read.option("header", True).schema("o_orderkey long, o_orderstatus string").csv(path)


def scan_entity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by nation, a document each."""
    path = shared_path(spark, "documents")
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("entity")).agg(F.sort_array(F.collect_list(F.struct(F.col("s_suppkey").alias("y")))).alias("list"))
    s.select("entity", F.to_json(F.struct("list")).alias("value")).repartition(1, "entity").write.partitionBy("entity").text(path)
    rows = src.scan_entity_documents(spark, path, "struct<y:bigint>", r"/entity=(\d+)/")
    return rows.select("entity_id", F.col("list_index").cast("long").alias("list_index"), F.col("item.y").alias("y"))


def scan_work_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work items of all customers from a CSV manifest."""
    path, k = shared_path(spark, "manifest"), F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://x/matches/"), F.floor(k / 2).cast("string"), F.lit("/live")).alias("url"), k.alias("line"))
    src.sink_json_csv(rows, path, "csv")
    return src.scan_work_manifest(spark, path)


def scan_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Override pairs of customers and suppliers."""
    path = shared_path(spark, "overrides")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("candidate_id"))
    src.sink_json_csv(s.select(F.col("candidate_id").alias("player_id"), "candidate_id"), path, "csv")
    return src.scan_overrides(spark, path, c, s)


def sink_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings by position after one partition was replaced."""
    path, rows = shared_path(spark, "parts"), projected(spark, sf_dir, "player_ratings").select("player_id", "match_id", "rating", "position_group")
    src.sink_partition_overwrite(rows, path, ["position_group"])
    src.sink_partition_overwrite(rows.where("position_group = 'Forward'").withColumn("rating", F.col("rating") + 1), path, ["position_group"])
    return rounded(spark.read.parquet(path))


def scan_match_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of completed matches, read from partitions."""
    path, events = shared_path(spark, "matches"), projected(spark, sf_dir, "match_events").select("match_id", "event_id", "type_name")
    src.sink_partition_overwrite(events.repartition("match_id"), path, ["match_id"])
    return src.scan_match_partitions(spark, path, events.select("match_id").where("match_id % 3 = 0")).withColumn("match_id", F.col("match_id").cast("long"))


_SCHEMA = "player_id long, match_id long, match_date date, minutes double, rating double"


def _streamed(spark: SparkSession, sf_dir: str, name: str, run: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """All ratings as three arrivals in order of date; the stream is started again for each, and goes on in the state that it left."""
    path, root = shared_path(spark, name), shared_path(spark, f"{name}-state")
    rows, before = projected(spark, sf_dir, "player_ratings").select("player_id", "match_id", "match_date", "minutes", "rating"), "1000-01-01"
    for cut in _CUTS:
        rows.where((F.col("match_date") >= before) & (F.col("match_date") < cut)).write.mode("append").parquet(path)
        table, before = run(stm.file_stream(spark, path, _SCHEMA), root), cut
    return table


def stream_form_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form state after a stream of all ratings."""
    return _flat(_streamed(spark, sf_dir, "arrivals", lambda s, root: stm.stream_form_state(s, root)))


def stream_upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rating of every player after a stream of upserts by player."""
    made = _streamed(spark, sf_dir, "upserts", lambda s, root: stm.stream_upsert(s.select("player_id", "match_id", "rating", "minutes"), ["player_id", "match_id"], path=root))
    return rounded(made)


QUERIES = (sink_json_csv, scan_entity_documents, scan_jsonl_strict, scan_work_manifest, scan_overrides, sink_partition_overwrite, scan_match_partitions, stream_form_state, stream_upsert_partitions)

_R = ctes("player_ratings")
ORACLES = {
    "sink_json_csv": "SELECT o_orderkey, o_orderstatus FROM orders",
    "scan_entity_documents": "SELECT s_nationkey AS entity_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS list_index, s_suppkey AS y FROM supplier",
    "scan_jsonl_strict": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "scan_work_manifest": "SELECT DISTINCT c_custkey // 2 AS match_id, 'https://x/matches/' || (c_custkey // 2) || '/live' AS match_url FROM customer",
    "scan_overrides": "SELECT s_suppkey AS player_id, s_suppkey AS candidate_id FROM supplier",
    "sink_partition_overwrite": rounded_sql(f"WITH {_R} SELECT player_id, match_id, CASE WHEN position_group = 'Forward' THEN rating + 1 ELSE rating END AS rating, position_group FROM player_ratings", ["rating"]),
    "scan_match_partitions": f"WITH {ctes('match_events')} SELECT match_id, event_id, type_name FROM match_events WHERE match_id % 3 = 0",
    "stream_form_state": FORMS["form_state"],
    "stream_upsert_partitions": rounded_sql(f"WITH {_R} SELECT player_id, match_id, rating, minutes FROM player_ratings", ["rating", "minutes"]),
}
