"""Keyed state on streams: form and upserted rows, held in state stores, resumed where they stopped and read back as tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tempoframe.functions.state import shared_path
from tempoframe.operators.form import HALF_LIFE, LAST

#: States are in RocksDB, of which a batch writes its changes.
_STORES = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_ITEM = "match_date date, match_id long, minutes double, rating double"


# Processors travel whole: the process that sets up a stateful step beside the driver need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FormProcessor(StatefulProcessor):
    """Of each player the decayed sums at the last match (a value) and the last twenty rated matches (a list).

    A batch reads and writes the states of its own players alone. Rows older than the state that the batch found, and rows without a date, are late: they
    change nothing and are returned.
    """

    def __init__(self, half_life: float = HALF_LIFE) -> None:
        self.half_life = half_life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "ewm_numerator double, ewm_denominator double, last_match_date date")
        self.recent = handle.getListState("recent", _ITEM)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.sums.get()  # each call is a round trip to the store
        top, bottom, stored = (0.0, 0.0, None) if kept is None else kept
        recent, end, changed = [] if kept is None else [tuple(r) for r in self.recent.get()], stored, False
        for row in rows:  # in any order
            date, minutes, rating = row["match_date"], row["minutes"], row["rating"]
            if date is None or stored is not None and date < stored:
                yield row
                continue
            changed = True
            if end is None or date > end:
                fade = 0.0 if end is None else 0.5 ** ((date - end).days / self.half_life)
                top, bottom, end = top * fade, bottom * fade, date
            if rating is None or rating != rating or minutes is None or not minutes > 0:
                continue
            weight = minutes * 0.5 ** ((end - date).days / self.half_life)
            top, bottom = top + weight * rating, bottom + weight
            recent.append((date, row["match_id"], minutes, rating))
            if len(recent) > 4 * LAST:
                recent = sorted(recent)[-LAST:]
        if changed:
            self.sums.update((top, bottom, end))
            if recent:  # a list of a player without rated matches does not exist
                self.recent.put(sorted(recent)[-LAST:])

    def close(self) -> None:
        pass


class UpsertProcessor(StatefulProcessor):
    """Of each key the row that came last: by batches, and within a batch by ``order``, else by all columns.

    With ``digest`` a row whose digest is the stored one is not written. Returned is each row that was written.
    """

    def __init__(self, keys: list[str], values: StructType, digest: str | None, order: str | None) -> None:
        self.keys, self.values, self.digest, self.order = keys, values, digest, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", self.values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.values.names

        def place(row: Row) -> list:
            given = [self.order] if self.order else []
            return [(row[c] is not None, row[c]) for c in (*given, *names) if not isinstance(row[c], dict)]

        last = None
        for row in rows:
            if last is None or place(row) >= place(last):
                last = row
        if last is None:
            return
        if self.digest and self.row.exists() and self.row.get()[names.index(self.digest)] == last[self.digest]:
            return
        self.row.update(tuple(last[c] for c in names))
        yield Row(**{c: last[c] for c in (*self.keys, *names)})

    def close(self) -> None:
        pass


def _advance(stream: DataFrame, made: Callable[[DataFrame], DataFrame], root: str, sink: str | None) -> None:
    """Runs what the stream has now through a stateful step, whose states and progress are kept in ``root``; rows that come out go to ``sink``, a folder a batch."""
    spark = stream.sparkSession

    def batch(df: DataFrame, n: int) -> None:
        if sink:
            df.write.mode("overwrite").parquet(f"{sink}/batch={n}")  # a repeated batch overwrites its own
        else:
            df.write.format("noop").mode("overwrite").save()

    before = {k: spark.conf.get(k, None) for k in _STORES}
    for k, v in _STORES.items():
        spark.conf.set(k, v)
    try:
        writer = made(stream).writeStream.outputMode("update").foreachBatch(batch)
        writer.option("checkpointLocation", root).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _state(spark: SparkSession, root: str, name: str | None) -> DataFrame:
    """A state variable (or, without a name, an aggregate's state) after the last batch, as it lies in the stores."""
    try:
        reader = spark.read.format("statestore")
        return (reader.option("stateVarName", name).option("flattenCollectionTypes", False) if name else reader).load(root)
    except PySparkException as e:
        raise ValueError("the stream had no rows") from e


def file_stream(spark: SparkSession, path: str, schema: str, files: int | None = None) -> DataFrame:
    """A stream of Parquet files: all that are new in one batch, or ``files`` a batch."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(path)


def stream_form_state(stream: DataFrame, path: str | None = None, late_path: str | None = None, half_life: float = HALF_LIFE) -> DataFrame:
    """Form state, as ``form_state`` gives it, after a stream of rated rows (dates as days); states are kept in ``path``, and a stream started again with it goes on.

    Rows without a player have no state. Rows older than their player's state go to ``late_path`` (if given), a folder a batch, and change nothing; ``apply_edits`` takes them in later.
    """
    spark, root = stream.sparkSession, path or shared_path(stream.sparkSession, "form-stream")
    rows = stream.select("player_id", "match_id", F.col("match_date").cast("date").alias("match_date"), F.col("minutes").cast("double"), F.col("rating").cast("double"))
    rows = rows.where("player_id is not null")
    shape = rows.schema
    _advance(rows, lambda s: s.groupBy("player_id").transformWithState(FormProcessor(half_life), shape, "Update", "None"), root, late_path)
    sums = _state(spark, root, "sums").select(F.col("key.player_id").alias("player_id"), "value.*")
    last = _state(spark, root, "recent").select(F.col("key.player_id").alias("player_id"), F.col("list_value").alias("recent"))
    return sums.join(last, "player_id", "left").withColumn("recent", F.coalesce("recent", F.array()))


#: The time of a batch and the row that came last, as the state of a key.
_NEWEST = "newest"


def _newest(stream: DataFrame, keys: list[str], names: list[str], order: str | None) -> DataFrame:
    """Each key of a batch with its last row, by a streaming aggregate: a row of a later batch is larger, as the batch's time comes first in it.

    A batch that is repeated has its first time again. A batch earlier than a row in the state (a clock that was put back) is an error.
    """
    now = F.current_timestamp()
    row = F.struct(now.alias("_time"), (F.col(order) if order else F.lit(0)).alias("_order"), F.struct(*names).alias("_row"))
    last = stream.select(*keys, row.alias(_NEWEST)).groupBy(*keys).agg(F.max(_NEWEST).alias(_NEWEST))
    back = F.raise_error(F.lit("a batch is older than a row in the state: the clock was put back"))
    checked = F.when(F.col(f"{_NEWEST}._time") > now, back.cast("boolean")).otherwise(F.lit(True))
    return last.where(checked).select(*keys, f"{_NEWEST}._row.*")


def stream_upsert(stream: DataFrame, keys: list[str], digest: str | None = None, path: str | None = None, order: str | None = None, changes: str | None = None) -> DataFrame:
    """The table after upserting every batch of a stream by key, kept in ``path``; the rows that a batch wrote go to ``changes`` (if given), a folder a batch.

    Of rows of a batch that share a key that counts which is last by ``order``, else by all columns. Without ``digest`` the state is that of a streaming aggregate and no
    row reaches Python; rows that hold maps, which have no order, take the processor of ``digest``.
    """
    spark, root, shape = stream.sparkSession, path or shared_path(stream.sparkSession, "upsert-stream"), stream.schema
    values = StructType([f for f in shape.fields if f.name not in keys])
    if digest is None and values.fields and "map<" not in values.simpleString() and "variant" not in values.simpleString():
        _advance(stream, lambda s: _newest(s, keys, values.names, order), root, changes)
        kept = _state(spark, root, None)
        newest = F.col("value")[kept.schema["value"].dataType.names[0]]  # the aggregate's only buffer
        return kept.select("key.*", newest["_row"].alias("_row")).select(*keys, "_row.*").select(*shape.names)
    out = StructType([*(shape[k] for k in keys), *values.fields])
    _advance(stream, lambda s: s.groupBy(*keys).transformWithState(UpsertProcessor(keys, values, digest, order), out, "Update", "None"), root, changes)
    return _state(spark, root, "row").select("key.*", "value.*").select(*shape.names)
