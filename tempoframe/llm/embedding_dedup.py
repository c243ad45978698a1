"""Embedding near-dedup: an exact metric range join over pivot cells with boundary replication."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.graph import connected_components, local_components
from tempoframe.llm.workspace import join_counted, staged, table

#: Vectors of a cell at the mean, most pivots, and vectors of a block that a task holds from either side of a cell.
CELL, MAX_PIVOTS, HOME_BLOCK, GUEST_BLOCK = 8_192, 1_024, 4_096, 16_384
#: Rows of a cosine tile.
_TILE = 256
_SLACK = 1e-6


def _units(values: list[np.ndarray]) -> np.ndarray:
    x = np.stack(values).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components leave the range of doubles
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _cells(pivots: np.ndarray, radius: float):
    """Emits every vector for its own cell and for each cell whose border is within ``radius`` and that meets its own.

    Two cells meet in one of the two, the lower or the higher one by the parity of their sum, so that a pair is compared once
    and every cell has about half of its neighbours.
    A vector x belongs to its nearest pivot p. A partner y in the cell of q with |x - y| <= radius has
    |y - q| <= |y - p|, so x lies within radius of the bisecting plane of p and q: (|x-q|² - |x-p|²) / (2 |p-q|) <= radius.
    """
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                x = _units(part.column("embedding").to_numpy(zero_copy_only=False).tolist())
                cos = x @ pivots.T
                home = cos.argmax(axis=1)
                margin = (cos[np.arange(len(x)), home][:, None] - cos) - radius * apart[home]
                other, own = np.arange(len(pivots))[None, :], home[:, None]
                meets = (other == own) | np.where((other + own) % 2 == 0, own < other, own > other)
                row, cell = np.nonzero((margin <= _SLACK) & meets)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(row)),
                        part.column("embedding").take(pa.array(row)),
                        part.column("copies").take(pa.array(row)),
                        pa.array(cell.astype(np.int32)),
                        pa.array(home[row] == cell),
                    ],
                    names=["vec_id", "embedding", "copies", "cell", "home"],
                )

    return run


def _block_join(threshold: float):
    def join(unit: pd.DataFrame) -> pd.DataFrame:
        """Counts the links between home vectors and guests of a block, for either end, and emits a spanning forest of them."""
        unit = unit.sort_values("vec_id", kind="stable").reset_index(drop=True)
        home, guest = unit[unit["as_home"]], unit[~unit["as_home"]]
        none = pd.DataFrame({"vec_id": [], "links": [], "root": []}).astype("int64")
        if not len(home) or not len(guest):
            return none
        (hid, hcopies), (gid, gcopies) = ((part["vec_id"].to_numpy(), part["copies"].to_numpy()) for part in (home, guest))
        inner = guest["home"].to_numpy()  # of two vectors of this cell the one with the larger id counts the pair
        h, g = _units(home["embedding"].tolist()), _units(guest["embedding"].tolist())
        h32, g32 = h.astype(np.float32), g.astype(np.float32)
        out, back = [], np.zeros(len(g), np.int64)
        for a in range(0, len(h), _TILE):
            i, j = np.nonzero(h32[a : a + _TILE] @ g32.T >= threshold - 1e-4)
            i += a
            ok = (hid[i] != gid[j]) & ~(inner[j] & (gid[j] > hid[i]))
            i, j = i[ok], j[ok]
            ok = np.einsum("ij,ij->i", h[i], g[j]) >= threshold
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            links = np.bincount(i, gcopies[j], len(h)).astype(np.int64)
            back += np.bincount(j, hcopies[i], len(g)).astype(np.int64)
            ids, at = np.unique(np.concatenate([hid[i], gid[j]]), return_inverse=True)
            root = local_components(at[: len(i)], at[len(i) :], len(ids))
            told = np.flatnonzero(links)
            out.append(pd.DataFrame({"vec_id": hid[told], "links": links[told], "root": hid[told]}))
            out.append(pd.DataFrame({"vec_id": ids, "links": 0, "root": ids[root]}))
        told = np.flatnonzero(back)
        out.append(pd.DataFrame({"vec_id": gid[told], "links": back[told], "root": gid[told]}))
        return pd.concat(out) if len(out) > 1 else none

    return join


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Links vectors with a cosine of ``threshold`` or more, in double precision, and groups them.

    Returns one row per input row: ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (smallest
    reachable vec_id) and ``kept`` (``vec_id = component_id``). Vectors that are null, empty or zero, or that hold null or
    non-finite components, link with nothing, and neither do vectors of different lengths; a row without an id counts as
    such a vector and is kept. Equal vectors are one from the start, and rows that share an id and vector link like
    any copies. Other columns are ignored; an empty table gives no rows.

    Unit vectors with cosine c are at distance sqrt(2 - 2c), so this is a metric range join: pivots, as many as the table
    needs cells, partition the vectors; the triangle inequality tells which borders a vector is near; cells join on their
    own, in blocks of bounded size. Of a block only counts and a spanning forest of links leave the task.
    """
    spark = vectors.sparkSession
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.select("vec_id", "embedding", F.coalesce(fine, F.lit(False)).alias("fine"))
    classes = staged(
        rows.where("fine").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes"
    )
    sizes = [r[0] for r in classes.select(F.size("embedding").alias("d")).distinct().collect()]
    found = None
    for d in sizes:
        part = _range_join(classes.where(F.size("embedding") == d), threshold)
        found = part if found is None else found.unionAll(part)
    member = join_counted(rows.where("fine").select("vec_id", "embedding"), classes, ["embedding"]).select("vec_id", "rep", "copies")
    rest = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is not None:
        found = staged(found, "links")
        links = found.where("links > 0").groupBy("vec_id").agg(F.sum("links").alias("links"))
        parts = connected_components(found.select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
        member = (
            member.join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
            .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
            .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
        )
        rest = member.unionAll(rest)
    return rest.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _range_join(classes: DataFrame, threshold: float) -> DataFrame:
    """``vec_id``, ``links`` and ``root`` of linked distinct vectors of one length."""
    n = classes.count()
    k = min(MAX_PIVOTS, max(1, math.ceil(n / CELL)))
    chosen = classes.orderBy(F.xxhash64("rep"), "rep").select("embedding").limit(k).collect()  # k is bounded
    pivots = np.unique(_units([np.asarray(r[0]) for r in chosen]), axis=0)
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK
    ids = classes.select(F.col("rep").alias("vec_id"), "embedding", "copies")
    kind = classes.schema["embedding"].dataType.simpleString()
    schema = f"vec_id long, embedding {kind}, copies long, cell int, home boolean"
    placed = staged(ids.mapInArrow(_cells(pivots, radius), schema), "cells")
    sizes = placed.groupBy("cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / HOME_BLOCK).alias("hb"), F.ceil(F.count("*") / GUEST_BLOCK).alias("gb")
    )  # a row a pivot
    spread = placed.join(F.broadcast(sizes), "cell")
    at = lambda n: F.pmod(F.xxhash64("vec_id"), F.greatest(F.lit(1), F.col(n)))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1).cast("long"), F.col(n)) - 1)
    cols = ["vec_id", "embedding", "copies", "cell"]
    homes = spread.where("home").select(*cols, "home", at("hb").alias("i"), F.explode(upto("gb")).alias("j"), F.lit(True).alias("as_home"))
    guests = spread.select(*cols, "home", F.explode(upto("hb")).alias("i"), at("gb").alias("j"), F.lit(False).alias("as_home"))
    return homes.unionAll(guests).groupBy("cell", "i", "j").applyInPandas(_block_join(threshold), "vec_id long, links long, root long")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at a cosine of 0.95 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


ORACLE = {
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS u, vec_id AS c FROM embeddings UNION SELECT e.w, r.c FROM r JOIN e ON e.u = r.u)
SELECT x.vec_id, (SELECT count(*) FROM e WHERE e.u = x.vec_id) AS n_links, m.c AS component_id, x.vec_id = m.c AS kept
FROM embeddings x JOIN (SELECT u, min(c) AS c FROM r GROUP BY u) m ON m.u = x.vec_id
"""
}
