"""Hard-negative mining: a vertical branch-and-bound scan (BOND) over blocks of quantised vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.workspace import best_rows, new_path, staged, table

#: Positives of an anchor, negatives of a positive, and the window of a negative's score in percent of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Components of a block that a task holds column by column, and of the anchors that are sent to tasks at a time.
BLOCK_CELLS, ANCHOR_CELLS = 1 << 18, 1 << 22
#: Anchors whose bounds are made at once.
_TILE = 512


class _Block:
    """Vectors of a block, a row for each dimension, sorted by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, kind: type, size: int) -> Iterator[_Block]:
    """Blocks of ``size`` vectors from Arrow batches of any size."""
    held: list[tuple[np.ndarray, ...]] = []
    count = 0

    def block() -> _Block:
        return _Block(*(np.concatenate(part) for part in zip(*held, strict=True)))

    for batch in batches:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        vectors = batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)
        at = 0
        while at < batch.num_rows:
            end = min(batch.num_rows, at + size - count)
            held.append((ids[at:end], labels[at:end], vectors[at:end].astype(kind)))
            count += end - at
            at = end
            if count == size:
                yield block()
                held, count = [], 0
    if count:
        yield block()


def _bounds(anchors: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each anchor's dimensions by descending magnitude, and the least and the most that those from each place on can add for any vector."""
    low, high = columns.min(axis=1), columns.max(axis=1)
    order = np.argsort(-np.abs(anchors), axis=1, kind="stable")
    sorted_ = np.take_along_axis(anchors, order, 1)
    one, two = sorted_ * low[order], sorted_ * high[order]
    none = np.zeros((len(anchors), 1), anchors.dtype)

    def rest(part: np.ndarray) -> np.ndarray:
        return np.concatenate([np.cumsum(part[:, ::-1], axis=1)[:, ::-1], none], axis=1)

    return order, rest(np.minimum(one, two)), rest(np.maximum(one, two))


def _scan(
    columns: np.ndarray, anchor: np.ndarray, order: np.ndarray, least: np.ndarray, most: np.ndarray, rows: np.ndarray,
    survive: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> tuple[np.ndarray, np.ndarray]:
    """Adds up the anchor's dimensions in ``order`` for the candidates ``rows``; after each step those stay whose bounds ``survive``.

    Returns the candidates that are left and their exact scores.
    """
    score = np.zeros(len(rows), columns.dtype)
    for at in range(0, len(order), STEP):
        dims = order[at : at + STEP]
        end = at + len(dims)
        if len(rows) * 2 > columns.shape[1]:
            score = score + (anchor[dims] @ columns[dims])[rows]
        else:
            score = score + anchor[dims] @ columns[np.ix_(dims, rows)]
        stay = survive(score + least[end], score + most[end])
        if not stay.all():
            rows, score = rows[stay], score[stay]
            if not len(rows):
                break
    return rows, score


class _Best:
    """The first ``k`` rows so far, by descending score and ascending id."""

    __slots__ = ("ids", "k", "scores")

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> int | None:
        """What a row must score to come in, if there are ``k`` already."""
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores.astype(np.int64)])
        first = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[first], scores[first]


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def _positives(ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, k: int, size: int):
    """A task's first ``k`` rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in ids]
        for block in _blocks(batches, anchors.shape[1], anchors.dtype.type, size):
            for label in np.unique(labels):
                start, end = block.of_label(label)
                mine = np.flatnonzero(labels == label)
                if start == end:
                    continue
                columns, own = block.columns[:, start:end], block.ids[start:end]
                for tile in range(0, len(mine), _TILE):
                    some = mine[tile : tile + _TILE]
                    order, least, most = _bounds(anchors[some], columns)
                    for i, a in enumerate(some):
                        floor = best[a].floor()

                        def survive(low: np.ndarray, high: np.ndarray, floor=floor) -> np.ndarray:
                            stay = np.ones(len(low), bool) if floor is None else high >= floor
                            return stay & (high >= _kth(low, k)) if len(low) >= k else stay

                        rows = np.flatnonzero(own != ids[a])
                        rows, score = _scan(columns, anchors[a], order[i], least[i], most[i], rows, survive)
                        if len(rows):
                            best[a].add(own[rows], score)
        yield _batch(
            anchor_id=[i for i, b in zip(ids, best, strict=True) for _ in b.ids],
            positive_id=[i for b in best for i in b.ids],
            positive_score=[s for b in best for s in b.scores],
        )

    return run


def _batch(**columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns.values()], names=list(columns))


def _negatives(ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, positives: list[np.ndarray], k: int, low: int, high: int, size: int):
    """A task's first ``k`` rows of other labels in the window of each of an anchor's different positive scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = [[(int(p), -((-low * int(p)) // 100), (high * int(p)) // 100, _Best(k)) for p in np.unique(scores)] for scores in positives]
        windows = [[w for w in own if w[1] <= w[2]] for own in windows]
        for block in _blocks(batches, anchors.shape[1], anchors.dtype.type, size):
            for tile in range(0, len(ids), _TILE):
                order, least, most = _bounds(anchors[tile : tile + _TILE], block.columns)
                for i, a in enumerate(range(tile, min(len(ids), tile + _TILE))):
                    start, end = block.of_label(labels[a])
                    rows = np.concatenate([np.arange(start), np.arange(end, len(block.ids))])
                    rows = rows[block.ids[rows] != ids[a]]
                    # The window still open: from its lower end, or the last of k found, to its upper end.
                    spans = [(bottom if best.floor() is None else best.floor(), top) for _, bottom, top, best in windows[a]]
                    if not spans or not len(rows):
                        continue
                    widest = min(s[0] for s in spans), max(s[1] for s in spans)

                    def survive(lower: np.ndarray, upper: np.ndarray, spans=spans, widest=widest) -> np.ndarray:
                        stay = (upper >= widest[0]) & (lower <= widest[1])
                        at = np.flatnonzero(stay)
                        lower, upper = lower[at], upper[at]
                        wanted = np.zeros(len(at), bool)
                        for bottom, top in spans:
                            sure = lower[(lower >= bottom) & (upper <= top)]
                            least_upper = max(bottom, _kth(sure, k)) if len(sure) >= k else bottom
                            wanted |= (upper >= least_upper) & (lower <= top)
                        stay[at] = wanted
                        return stay

                    rows, score = _scan(block.columns, anchors[a], order[i], least[i], most[i], rows, survive)
                    for (bottom, top), (_, _, _, best) in zip(spans, windows[a], strict=True):
                        inside = (score >= bottom) & (score <= top)
                        if inside.any():
                            best.add(block.ids[rows[inside]], score[inside])
        found = [(a, p, best) for a, own in zip(ids, windows, strict=True) for p, _, _, best in own]
        yield _batch(
            anchor_id=[a for a, _, b in found for _ in b.ids],
            positive_score=[p for _, p, b in found for _ in b.ids],
            negative_id=[i for _, _, b in found for i in b.ids],
            negative_score=[s for _, _, b in found for s in b.scores],
        )

    return run


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE
) -> DataFrame:
    """Hard negatives of each positive of each row that ``anchors`` (a condition on ``vec_id`` and ``label``) names.

    Components x are quantised to floor(scale * x); a score is the integer inner product with the anchor, higher scores come
    first, ties by the smaller vec_id. An anchor's positives are its first ``positives`` other rows of the same (integer) label; of the rows with
    another label whose score lies within ``low`` and ``high`` percent of the positive's, the first ``negatives`` are returned:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null vec_id, label or vector or with a null or non-finite component take no part. Rows that share a vec_id are one, that with
    the smallest label and vector. Vectors of different lengths do not meet; empty ones score 0 with each other. Other columns are ignored; an
    empty table, or one without anchors, gives no rows. A table with components so large that scores could leave 64 bits raises a ValueError.

    Rows lie in blocks, column by column. An anchor reads the dimensions of a block in the descending order of its own magnitudes; what the rest can
    still add, by the block's least and greatest components, bounds every candidate's score from both sides, and the candidates shrink to those that can be
    among the wanted until scores are exact. Tasks keep the best of all their blocks, so later blocks start with narrow bounds. All rows are scanned
    for all anchors, these in broadcast portions of ``ANCHOR_CELLS`` components; the work grows with rows times anchors.
    """
    spark = vectors.sparkSession
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(whole)
    size = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    rows = rows.select("vec_id", "label", size.alias("size"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("q"))
    first = rows.groupBy("vec_id").agg(F.min(F.struct("label", "q", "size")).alias("r")).select("vec_id", "r.label", "r.q", "r.size")
    one = staged(first, "vectors")
    kinds = one.groupBy(F.size("q").alias("d")).agg(F.max("size").alias("most"), F.count("*").alias("n"), F.count_if(anchors).alias("anchors")).collect()
    near, found = new_path(spark, "positives"), new_path(spark, "negatives")
    near_schema = "anchor_id long, positive_id long, positive_score long"
    found_schema = "anchor_id long, positive_score long, negative_id long, negative_score long"
    for kind in kinds:  # a row for each length of vectors
        limit = (math.ceil((kind.most or 0) * scale) + 1) ** 2 * max(1, kind.d)
        if limit >= 1 << 62:
            raise ValueError(f"components of up to {kind.most} have scores beyond 64 bits")
        exact = np.float64 if limit < 1 << 52 else np.int64  # sums of whole numbers are exact in doubles up to there
        own = one.where(F.size("q") == kind.d).select("vec_id", "label", "q")
        size = max(1, BLOCK_CELLS // max(1, kind.d))
        own = staged(own.repartition(math.ceil(kind.n / size)), "blocks")
        portions = math.ceil(kind.anchors * max(1, kind.d) / ANCHOR_CELLS)
        for portion in range(portions):
            chosen = own.where(anchors & (F.pmod(F.xxhash64("vec_id"), F.lit(portions)) == portion)).toPandas().sort_values("vec_id")
            if not len(chosen):
                continue
            ids, labels = chosen["vec_id"].to_numpy(np.int64), chosen["label"].to_numpy(np.int64)
            x = np.array(chosen["q"].tolist(), exact).reshape(len(chosen), kind.d)
            local = own.mapInArrow(_positives(ids, labels, x, positives, size), near_schema)
            path = new_path(spark, "nearest")
            best_rows(local, ["anchor_id"], [F.desc("positive_score"), F.asc("positive_id")], positives, "rank").drop("rank").write.parquet(path)
            best = spark.read.schema(near_schema).parquet(path)
            best.write.mode("append").parquet(near)
            scores = best.select("anchor_id", "positive_score").distinct().toPandas()  # a few for each anchor of the portion
            per = dict(scores.groupby("anchor_id")["positive_score"].apply(lambda s: s.to_numpy(np.int64)))
            windows = [per.get(i, np.zeros(0, np.int64)) for i in ids]
            local = own.mapInArrow(_negatives(ids, labels, x, windows, negatives, low, high, size), found_schema)
            order = [F.desc("negative_score"), F.asc("negative_id")]
            best_rows(local, ["anchor_id", "positive_score"], order, negatives, "rank").write.mode("append").parquet(found)
    none = spark.createDataFrame([], near_schema), spark.createDataFrame([], found_schema + ", rank int")
    none[0].write.mode("append").parquet(near)
    none[1].write.mode("append").parquet(found)
    pairs = spark.read.schema(near_schema).parquet(near).join(spark.read.schema(found_schema + ", rank int").parquet(found), ["anchor_id", "positive_score"])
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings whose vec_id is divisible by 50; every seventh id has the next label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


ORACLE = {
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3
"""
}
