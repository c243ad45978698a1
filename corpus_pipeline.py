"""The corpus pipeline: stages that turn ``documents`` into shards of a training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm import decontaminate, mixing, near_dup, quality, shards
from tempoframe.llm.workspace import new_path, staged, table

#: Share of the target weight that the mixing stage may leave to sources, languages and topics with too few tokens.
UNMET = 0.02


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a number that no other row has: decisions are made and applied row by row, whatever doc_ids are null or repeat."""
    if "_row" in docs.columns:
        raise ValueError("documents may not have a column _row")
    return staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The numbered ``docs`` but those in ``rows``, as they came."""
    return docs.join(staged(rows.select("_row").distinct(), "gone"), "_row", "left_anti").drop("_row")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject. Null and empty texts are judged like others, by their statistics; so are rows without an id."""
    forest = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, forest)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, that with the smallest doc_id (null last); among rows that share it, any one.

    Rows with null or wordless texts are in no group and stay, repeated ones too.
    """
    rows = _numbered(docs)
    found = near_dup.near_duplicates(rows, words=5, threshold=80, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    # Groups of two rows or more; the others need no choice.
    large = found.where("_row <> component_id").select("component_id").distinct()
    members = staged(found.join(large, "component_id", "left_semi"), "members").join(rows.select("_row", "doc_id"), "_row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = members.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first._row").alias("_row"))
    return _without(rows, members.select("_row").join(staged(first, "first"), "_row", "left_anti"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage; null and short texts hold none."""
    rows = _numbered(docs)
    found = decontaminate.contaminated(rows.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(rows, found.select(F.col("doc_id").alias("_row")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The largest sample whose tokens meet the target weights of sources, languages and topics but for ``UNMET``.

    Texts without words weigh nothing and stay; rows that share a doc_id fall alike, rows without one by their text.
    """
    return mixing.sampled(docs, keep=None, unmet=UNMET)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row that is left, null texts and repeated ids included."""
    return shards.shard_documents(docs, n_shards=8)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The quality classifier has no SQL form, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; what each keeps is written as Parquet and read again.

    Every stage decides row by row, so null and repeated doc_ids lose no rows and hide none. Empty tables give no rows;
    a column of ``documents`` may have any name but ``_row`` and those that begin with ``_mix_``.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
