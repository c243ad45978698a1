"""File scans and sinks. Paths may be anything that Spark can read."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tempoframe.functions.state import written
from tempoframe.operators.serving import merge_upsert

#: Rows of a part of a keyed table when it is first written.
PART_ROWS = 1_000_000


def _schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _lines(spark: SparkSession, path: str, shape: StructType) -> DataFrame:
    """Lines with the file, the block that a task reads them from, a number that rises along a block, the parsed row ``r`` and whether it is ``bad``."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    row = F.from_json("value", StructType([*shape.fields, StructField("_bad", StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    lines = spark.read.text(path).select("value", *place).withColumn("r", row)
    blank = F.trim("value", F.lit(" \t\r\n")) == ""
    return lines.withColumn("bad", ~blank & (F.col("r._bad").isNotNull() | ~F.ltrim("value").startswith("{")))


def jsonl_faults(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """``file``, ``line`` (from 1) and ``text`` (its first 200 characters) of every line that is neither blank nor an object of the schema, whatever blocks files are read in.

    Lines are counted block by block; only files with a fault take part in the second step.
    """
    lines = _lines(spark, path, _schema(schema))
    bad = lines.where("bad").select("file", "block", "at", F.left("value", F.lit(200)).alias("text"))
    files = bad.select("file").distinct()
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n")).join(files, "file", "left_semi")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return bad.join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "text")


def scan_jsonl_strict(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of JSON lines, blank lines left out; all lines are checked first, and the first that is no object of the schema raises a ValueError with its file and line."""
    shape = _schema(schema)
    first = jsonl_faults(spark, path, shape).orderBy("file", "line").first()
    if first is not None:
        raise ValueError(f"{first['file']}, line {first['line']}: not a JSON object of the schema: {first['text']}")
    return _lines(spark, path, shape).where(F.trim("value", F.lit(" \t\r\n")) != "").select(*(F.col(f"r.{f.name}").alias(f.name) for f in shape.fields))


def hash_files(spark: SparkSession, path: str, name: str, group: str) -> DataFrame:
    """SHA-256 of the files below ``path``, put together by groups: ``signature`` of the sorted (name, digest) pairs of each ``group`` and the number of ``files``.

    ``name`` and ``group`` are patterns that take a file's name and group from its path. Bytes are hashed where they are read; a file has to fit into
    ``spark.sql.sources.binaryFile.maxLength``. Empty files are not seen: the scan has no rows for them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rows = files.select(F.regexp_extract("path", group, 1).alias("group"), F.regexp_extract("path", name, 1).alias("name"), F.sha2("content", 256).alias("digest"))
    line = F.concat_ws(":", "name", "digest")
    return rows.groupBy("group").agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n").cast("binary"), 256).alias("signature"), F.count("*").alias("files"))


def scan_entity_documents(spark: SparkSession, path: str, element: str, pattern: str = r"/(\d+)\.json$") -> DataFrame:
    """One JSON document per file: ``entity_id`` from the file's path by ``pattern``, and each element of its ``list`` with its place; an empty list gives one row of nulls."""
    docs = spark.read.option("wholetext", True).text(path).select(
        F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("long").alias("entity_id"), F.from_json("value", f"list array<{element}>").alias("d")
    )
    return docs.select("entity_id", F.posexplode_outer("d.list").alias("list_index", "item"))


def scan_work_manifest(spark: SparkSession, path: str, kind: str = "csv", limit: int | None = None) -> DataFrame:
    """Work items of a manifest: ``match_url`` (or ``url``, ``source_url``), ``match_id`` from the URL if absent; the last of repeats stands, in order of id.

    ``kind`` is csv, parquet or text (a URL a line).
    """
    raw = spark.read.option("header", True).csv(path) if kind == "csv" else spark.read.parquet(path) if kind == "parquet" else spark.read.text(path).withColumnRenamed("value", "match_url")
    have = [F.col(c) for c in ("match_url", "url", "source_url") if c in raw.columns]
    rows = raw.select(F.coalesce(*have).alias("match_url"), *(F.col(c) for c in ("match_id", "line") if c in raw.columns))
    own = F.regexp_extract("match_url", r"/(\d+)(?:[/?#]|$)", 1).try_cast("long")
    ident = F.coalesce(F.col("match_id").try_cast("long"), own) if "match_id" in raw.columns else own
    order = F.col("line").try_cast("long").desc() if "line" in raw.columns else F.col("match_url").desc()
    n = F.row_number().over(Window.partitionBy("match_id").orderBy(order))
    last = rows.withColumn("match_id", ident).where("match_id is not null").withColumn("_n", n).where("_n = 1").select("match_id", "match_url")
    return last if limit is None else last.orderBy("match_id").limit(limit)


def scan_overrides(spark: SparkSession, path: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Approved id pairs of a CSV file; an id that is unknown on its side raises an error when it is read."""
    pairs = spark.read.option("header", True).schema("player_id long, candidate_id long").csv(path).dropna().distinct()
    known = pairs.join(left.select("player_id", F.lit(1).alias("_l")).distinct(), "player_id", "left").join(right.select("candidate_id", F.lit(1).alias("_r")).distinct(), "candidate_id", "left")
    lost = F.col("_l").isNull() | F.col("_r").isNull()
    return known.select(F.when(lost, F.raise_error(F.lit("an override names an unknown id")).cast("long")).otherwise(F.col("player_id")).alias("player_id"), "candidate_id")


def sink_partition_overwrite(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces the partitions that ``df`` has rows of and leaves the others; the job's commit makes it atomic by partition."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def _part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def keyed_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``sink_keyed_upsert`` keeps."""
    return spark.read.parquet(path).drop("_parts", "_part")


def sink_keyed_upsert(df: DataFrame, path: str, keys: list[str], digest: str | None = None, order: list[str] | None = None) -> DataFrame:
    """Upserts rows by key into a Parquet table at ``path`` and returns what was done, one row: ``inserted``, ``updated``, ``unchanged`` and ``parts_written``.

    The table lies in parts by the hash of its keys, of ``PART_ROWS`` rows when it was first written. Rows that are new or differ (by ``digest``, else in any
    column) are found in the parts that hold their keys, and only parts with such a row are written again: the same source a second time writes nothing.
    Of repeated source keys one row counts, the last by ``order``, else the first by all columns. One writer at a time: two at once may each lose what the other wrote in a
    part that both write.
    """
    spark, shape = df.sparkSession, "inserted long, updated long, unchanged long, parts_written long"
    source = written(merge_upsert(df.limit(0), df, keys, None, order), "upsert-source")
    try:
        current = spark.read.parquet(path)
    except AnalysisException:
        current = None
    if current is None:
        n = source.count()
        parts = max(1, math.ceil(n / PART_ROWS))
        sink_partition_overwrite(source.withColumns({"_parts": F.lit(parts), "_part": _part(keys, parts)}).repartition(parts, "_part"), path, ["_parts", "_part"])
        return spark.createDataFrame([(n, 0, 0, parts)], shape)
    parts = current.select("_parts").first()[0]
    near = [r[0] for r in source.select(_part(keys, parts)).distinct().collect()]  # as many as parts
    own = current.where(F.col("_part").isin(near))
    rest = [digest] if digest else [c for c in source.columns if c not in keys]
    same = F.lit(True)
    for c in rest:
        same = same & F.col(c).eqNullSafe(F.col(f"_was.{c}"))
    known = own.select(*keys, F.struct(*rest).alias("_was"), F.lit(True).alias("_known"))
    state = F.when(F.col("_known").isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    compared = written(source.join(known, keys, "left").withColumn("_state", state).select(*source.columns, "_state"), "upsert-compared")
    moved = compared.where("_state <> 'unchanged'").drop("_state")
    touched = [r[0] for r in moved.select(_part(keys, parts)).distinct().collect()]
    if touched:
        after = merge_upsert(current.where(F.col("_part").isin(touched)).select(*source.columns), moved, keys)
        after = written(after.withColumns({"_parts": F.lit(parts), "_part": _part(keys, parts)}).repartition("_part"), "upsert-parts")
        sink_partition_overwrite(after, path, ["_parts", "_part"])
    counts = {r["_state"]: r["count"] for r in compared.groupBy("_state").count().collect()}
    return spark.createDataFrame([(*(counts.get(c, 0) for c in ("inserted", "updated", "unchanged")), len(touched))], shape)


def scan_match_partitions(spark: SparkSession, path: str, completed: DataFrame) -> DataFrame:
    """Rows of partitioned matches that have a completion marker (``match_id``)."""
    return spark.read.parquet(path).join(completed.select("match_id").distinct(), "match_id", "left_semi")


def sink_json_csv(df: DataFrame, path: str, kind: str = "json") -> None:
    """Exports rows as JSON lines or as CSV with a header."""
    writer = df.write.mode("errorifexists")
    writer.json(path) if kind == "json" else writer.option("header", True).csv(path)
