"""Sharding: best-fit-decreasing packing of indivisible groups into bins of fixed capacity."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempoframe.llm.workspace import join_counted, staged, table

#: Groups of a packing task, at the mean, until there are so many tasks; documents of a numbering task over all shards, at the mean.
GROUPS_A_BLOCK, MAX_BLOCKS, ROWS_A_BUCKET = 50_000, 4_096, 500_000
#: Large parts of a shard, small parts of a large one, and the share of a block's bytes that goes to large ones.
PARTS, FINE, COARSE_SHARE = 64, 32, 0.9


@dataclass(slots=True)
class _Node:
    key: tuple[int, int]
    level: int = 1
    left: _Node | None = None
    right: _Node | None = None


def _skew(n: _Node | None) -> _Node | None:
    if n and n.left and n.left.level == n.level:
        low = n.left
        n.left, low.right = low.right, n
        return low
    return n


def _split(n: _Node | None) -> _Node | None:
    if n and n.right and n.right.right and n.right.right.level == n.level:
        up = n.right
        n.right, up.left = up.left, n
        up.level += 1
        return up
    return n


class RoomTree:
    """Open bins in a balanced (AA) tree, ordered by the room that is left."""

    def __init__(self) -> None:
        self._root: _Node | None = None

    def tightest(self, size: int) -> tuple[int, int] | None:
        """(room, bin) of the least room that is enough, the lowest bin among equals."""
        n, found = self._root, None
        while n:
            if n.key[0] >= size:
                n, found = n.left, n.key
            else:
                n = n.right
        return found

    def add(self, room: int, at: int) -> None:
        self._root = self._put(self._root, (room, at))

    def remove(self, room: int, at: int) -> None:
        self._root = self._take(self._root, (room, at))

    def _put(self, n: _Node | None, key: tuple[int, int]) -> _Node:
        if n is None:
            return _Node(key)
        if key < n.key:
            n.left = self._put(n.left, key)
        else:
            n.right = self._put(n.right, key)
        return _split(_skew(n))

    def _take(self, n: _Node | None, key: tuple[int, int]) -> _Node | None:
        if n is None:
            return None
        if key < n.key:
            n.left = self._take(n.left, key)
        elif key > n.key:
            n.right = self._take(n.right, key)
        elif n.left is None:
            return n.right
        else:
            near = n.left
            while near.right:
                near = near.right
            n.key, n.left = near.key, self._take(n.left, near.key)
        level = min(n.left.level if n.left else 0, n.right.level if n.right else 0) + 1
        if level < n.level:
            n.level = level
            if n.right and n.right.level > level:
                n.right.level = level
        n = _skew(n)
        n.right = _skew(n.right)
        if n.right:
            n.right.right = _skew(n.right.right)
        n = _split(n)
        n.right = _split(n.right)
        return n


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size; ``sizes`` fall. A size over the capacity gets a bin of its own."""
    rooms, out, opened = RoomTree(), [], 0
    for size in sizes:
        found = rooms.tightest(size)
        if found is None:
            out.append(opened)
            left, at = capacity - size, opened
            opened += 1
        else:
            rooms.remove(*found)
            left, at = found[0] - size, found[1]
            out.append(at)
        if left > 0:
            rooms.add(left, at)
    return out


def _fewest(sizes: list[int], bins: int, total: int) -> list[int]:
    """Packing into at most ``bins`` bins at (nearly) the least capacity for which best fit needs no more."""
    low, high = max(-(-total // bins), sizes[0]), total
    best = None
    guess = low
    while True:
        packed = best_fit(sizes, guess)
        if max(packed) < bins:
            best, high = packed, guess
        else:
            low = guess + 1
        if low >= high or (best is not None and high - low <= total // 100_000):
            return best if best is not None else best_fit(sizes, high)
        step = max(1, (total // bins) // 2_000)
        guess = min(low + step, high - 1) if best is None and low + step < high else (low + high) // 2


def _packer(coarse: int, fine: int):
    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
        big = int((block["size"].cumsum() <= COARSE_SHARE * block["size"].sum()).sum())
        sizes = block["size"].tolist()
        large = best_fit(sizes[:big], coarse)
        above = max(large, default=-1) + 1
        block["part"] = large + [above + x for x in best_fit(sizes[big:], fine)]
        return block[["key", "block", "size", "copies", "part"]]

    return pack


def shard_documents(docs: DataFrame, n_shards: int = 8, capacity: int | None = None) -> DataFrame:
    """Puts every document into a shard so that shards hold nearly as many bytes each; equal texts stay together.

    A document takes its UTF-8 bytes plus one; a null text takes one, and null texts are a group of their own, with
    ``text_crc32`` 0. With ``capacity`` given, the number of shards follows from it instead: as many as best fit opens for
    the parts. A group larger than a shard fills one alone (and exceeds it, as groups are not cut).

    Returns ``doc_id``, ``size``, ``text_crc32``, ``law`` ('bytes'), ``shard``, ``slot`` (from 0 without gaps in each
    shard) and ``grown_shard`` (null: this law says nothing of it), one row per input row, repeated and null ids included; an
    empty table gives none. Other columns are ignored.

    Packing has two levels, both best-fit-decreasing: groups of a block into parts of bounded capacity, block by block in
    parallel, then all parts into the shards. A group larger than a part is a part of its own, so large groups are
    placed among all by their size; the order by size of smaller ones holds within their block. The parts, a few
    thousand for the shards and a few for each of at most ``MAX_BLOCKS`` blocks, are packed on the driver.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.when(F.col("text").isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.sha2(text, 256))).alias("key")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key,
    )
    sized = staged(sized, "sized")
    groups = staged(sized.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("copies")), "groups")
    count, total, rows = groups.agg(F.count("*"), F.sum("size"), F.sum("copies")).first()
    if not count:
        parts = groups.select("key", "copies", F.lit(0).alias("shard"))
    else:
        room = capacity or -(-total // n_shards)
        coarse = max(1, room // PARTS)
        blocks = min(math.ceil(count / GROUPS_A_BLOCK), MAX_BLOCKS)
        blocked = groups.select("key", "size", "copies", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"))
        packed = staged(
            blocked.groupBy("block").applyInPandas(
                _packer(coarse, max(1, coarse // FINE)), "key binary, block long, size long, copies long, part long"
            ),
            "parts",
        )
        sums = packed.groupBy("block", "part").agg(F.sum("size").alias("size")).collect()  # bounded by MAX_BLOCKS and the shards
        sums.sort(key=lambda r: (-r["size"], r["block"], r["part"]))
        sizes = [r["size"] for r in sums]
        placed = best_fit(sizes, capacity) if capacity else _fewest(sizes, n_shards, total)
        where = docs.sparkSession.createDataFrame(
            [(r["block"], r["part"], s) for r, s in zip(sums, placed, strict=True)], "block long, part long, shard int"
        )
        parts = packed.join(F.broadcast(where), ["block", "part"]).select("key", "copies", "shard")
    buckets = max(64, math.ceil((rows or 0) / ROWS_A_BUCKET))
    bucket = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).alias("bucket")
    put = staged(join_counted(sized, staged(parts, "shards"), ["key"]).select("doc_id", "size", "text_crc32", "shard", bucket), "placed")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = put.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        put.withColumn("i", F.row_number().over(within))
        .join(F.broadcast(starts), ["shard", "bucket"])  # a row for each shard and half a million documents
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("i") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of nearly equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=8)
