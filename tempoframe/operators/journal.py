"""A record of the stages of a run, kept beside their tables: what is done is not done again, and what failed is told."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RECORD = "at double, run string, step int, stage string, signature string, status string, rows long, error string"


def table_signature(df: DataFrame) -> str:
    """A digest of a table's schema and rows in any order, in one pass."""
    each = F.xxhash64(*df.columns) if df.columns else F.lit(0).cast("long")
    n, total, mixed = df.agg(F.count("*"), F.coalesce(F.sum(each.cast("decimal(38,0)")), F.lit(0)), F.bit_xor(each)).first()
    return hashlib.sha256(f"{df.schema.json()}:{n}:{total}:{mixed}".encode()).hexdigest()


class Journal:
    """Stages of runs below ``path``.

    Before a stage runs it is recorded as 'started', afterwards as 'succeeded' or, with the error, as 'failed'; a run that ends with an error is 'failed' as a whole.
    A stage is known by its name, the signatures of what it reads and ``version``, the version of its code. If that has succeeded before, in whatever run, its
    table is read again and the stage is 'reused': a rerun after a failure starts at the stage that failed, and a change of an input repeats what depends on it.
    """

    def __init__(self, spark: SparkSession, path: str, version: str = "1") -> None:
        self.spark, self.path, self.version = spark, path.rstrip("/"), version
        self.run, self.step, self.signatures = uuid.uuid4().hex[:12], 0, {}

    def _note(self, stage: str, signature: str, status: str, rows: int | None = None, error: str | None = None) -> None:
        row = [(time.time(), self.run, self.step, stage, signature, status, rows, error)]
        self.spark.createDataFrame(row, _RECORD).coalesce(1).write.mode("append").json(f"{self.path}/journal")

    def records(self) -> DataFrame:
        """All records of all runs."""
        try:
            return self.spark.read.schema(_RECORD).json(f"{self.path}/journal")
        except AnalysisException:
            return self.spark.createDataFrame([], _RECORD)

    def input(self, name: str, df: DataFrame | None) -> DataFrame | None:
        """Names a table, or its absence, that stages read from outside."""
        self.signatures[name] = "none" if df is None else table_signature(df)
        return df

    def place(self, name: str) -> str:
        """The folder of a stage's table in this run; what else a stage keeps is beside it."""
        return f"{self.path}/{name}/{self.signatures[name]}"

    def stage(self, name: str, reads: Sequence[str], make: Callable[[str], DataFrame], parameters: object = None, status: str = "succeeded") -> DataFrame:
        """The table of a stage that reads the named inputs and stages, made now (by ``make``, which is given the folder) or before."""
        self.step += 1
        parts = [name, self.version, json.dumps(parameters, default=str), *(f"{r}={self.signatures[r]}" for r in reads)]
        signature = hashlib.sha256("|".join(parts).encode()).hexdigest()[:32]
        self.signatures[name] = signature
        place = self.place(name)
        done = self.records().where((F.col("stage") == name) & (F.col("signature") == signature) & ~F.col("status").isin("started", "failed"))
        known = done.orderBy(F.col("at").desc()).first()
        if known is not None:
            self._note(name, signature, "reused", known["rows"])
            return self.spark.read.parquet(place)
        self._note(name, signature, "started")
        try:
            make(place).write.mode("overwrite").parquet(place)  # what a failed attempt left is replaced
            table = self.spark.read.parquet(place)
            self._note(name, signature, status, table.count())
        except Exception as e:
            self._note(name, signature, "failed", error=f"{type(e).__name__}: {str(e)[:500]}")
            raise
        return table

    def whole(self, work: Callable[[Journal], DataFrame]) -> DataFrame:
        """Runs ``work`` and records the run as 'succeeded' or 'failed', whichever way it ends; returns the last status of each stage of the run."""
        self._note("run", self.run, "started")
        try:
            work(self)
        except Exception as e:
            self.step += 1
            self._note("run", self.run, "failed", error=f"{type(e).__name__}: {str(e)[:500]}")
            raise
        self.step += 1
        self._note("run", self.run, "succeeded")
        return self.outcome()

    def latest(self, name: str) -> DataFrame:
        """The table that a stage made last, in whatever run."""
        done = self.records().where((F.col("stage") == name) & ~F.col("status").isin("started", "failed")).orderBy(F.col("at").desc()).first()
        if done is None:
            raise ValueError(f"stage {name} has not succeeded yet")
        return self.spark.read.parquet(f"{self.path}/{name}/{done['signature']}")

    def outcome(self) -> DataFrame:
        """The last record of each stage of this run: ``step``, ``stage``, ``rows``, ``status``, ``error``."""
        mine = self.records().where(F.col("run") == self.run)
        last = mine.groupBy("stage").agg(F.max_by(F.struct("step", "rows", "status", "error"), "at").alias("r"))
        return last.select("r.step", "stage", "r.rows", "r.status", "r.error")
