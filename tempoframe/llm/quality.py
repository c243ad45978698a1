"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened for vectorised traversal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm import kernels
from tempoframe.llm.workspace import table

#: The classifier is fitted on at most this many labelled rows, those with the smallest hashes of their ids.
MAX_TRAINING_ROWS = 20_000
#: A document whose score reaches this is predicted to be of good quality.
CUT = 0.3

_SENTENCE_MARKS = ".,;:'\"-()"
_SHOUT_MARKS = "!?"


def _byte_classes() -> np.ndarray:
    rows = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        rows[b] = (
            "A" <= c <= "Z", "a" <= c <= "z", "0" <= c <= "9", b >= 128, c in _SENTENCE_MARKS, c in _SHOUT_MARKS,
            33 <= b < 127 and not c.isalnum() and c not in _SENTENCE_MARKS + _SHOUT_MARKS, c == "\n",
        )
    return rows


_CLASSES = _byte_classes()
FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "upper_share", "digit_share", "wide_share", "mark_share", "shout_share",
    "symbol_share", "words_per_line", "distinct_words", "top_word", "distinct_triples", "distinct_lines", "letter_share",
)


def text_features(column: pa.Array) -> np.ndarray:
    """Statistics of whole texts, one row each; nulls count as empty. Nothing but the text is read."""
    out = np.zeros((len(column), len(FEATURES)))
    texts = column.cast(pa.large_binary())
    for i, words in enumerate(kernels.text_words(column)):
        raw = texts[i].as_py() or b""
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
        upper, lower, digit, wide, mark, shout, symbol, breaks = counts
        size, n = max(len(raw), 1), max(len(words), 1)
        _, times = np.unique(words, return_counts=True)
        triples = max(len(words) - 2, 1)
        lines = raw.split(b"\n")
        out[i] = (
            np.log1p(len(raw)), np.log1p(len(words)), len(raw) / n, upper / max(upper + lower, 1), digit / size, wide / size,
            mark / size, shout / size, symbol / size, len(words) / (breaks + 1), len(times) / n,
            (times.max() if len(times) else 0) / n, len(kernels.shingle_set(words, 3)) / triples,
            len(set(lines)) / len(lines), (upper + lower + wide) / size,
        )
    return out


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: all rows step down all trees together."""
        if not len(x):
            return np.zeros(0)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] > self.threshold[at], self.right[at], self.left[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 4.0, ridge: float = 1.0
) -> Forest:
    """Boosted trees for the logistic loss from gradient histograms over quantile bins.

    Without rows, or with one class only, the forest has no trees and scores the (smoothed) share of label 1, a half if there are no rows.
    """
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    parts: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value", "roots")}
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        raw = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            raw += _grow(binned, edges, p - y, p * (1 - p), depth, rate, bins, least, ridge, parts)
    arrays = {k: np.asarray(v, np.float64 if k in ("threshold", "value") else np.int64) for k, v in parts.items()}
    return Forest(**arrays, depth=depth, base=base)


def _grow(binned, edges, grad, hess, depth, rate, bins, least, ridge, parts) -> np.ndarray:
    """Adds one tree, level by level, and returns its step for each training row."""
    start = len(parts["feature"])
    parts["roots"].append(start)

    def add(g: float, h: float) -> int:
        k = len(parts["feature"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", -rate * g / (h + ridge))):
            parts[name].append(v)
        return k

    node = np.full(len(grad), add(grad.sum(), hess.sum()))
    level = [start]
    for _ in range(depth):
        slot = np.full(len(parts["feature"]), -1)
        slot[level] = np.arange(len(level))
        place = slot[node]
        live = place >= 0
        g, h, at = grad[live], hess[live], place[live]
        best = [(1e-9, -1, -1)] * len(level)
        sums = {}
        for f in range(binned.shape[1]):
            key, size = at * bins + binned[live, f], len(level) * bins
            gl = np.bincount(key, g, size).reshape(-1, bins).cumsum(axis=1)
            hl = np.bincount(key, h, size).reshape(-1, bins).cumsum(axis=1)
            gt, ht = gl[:, -1:], hl[:, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = -1
            gain[:, len(edges[f]) :] = -1
            for k, b in enumerate(gain.argmax(axis=1)):
                if gain[k, b] > best[k][0]:
                    best[k] = (gain[k, b], f, b)
                    sums[k] = (gl[k, b], hl[k, b], gt[k, 0] - gl[k, b], ht[k, 0] - hl[k, b])
        below = []
        for k, (_, f, b) in enumerate(best):
            if f < 0:
                continue
            parent, (ga, ha, gb, hb) = level[k], sums[k]
            a, c = add(ga, ha), add(gb, hb)
            parts["feature"][parent], parts["threshold"][parent] = f, float(edges[f][b])
            parts["left"][parent], parts["right"][parent] = a, c
            mine = node == parent
            node[mine] = np.where(binned[mine, f] > b, c, a)
            below += [a, c]
        level = below
        if not level:
            break
    return np.asarray(parts["value"])[node]


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = text_features(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c) for c in x.T)], names=["y", *FEATURES]
        )


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept out of the fitting: crc32 of its id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Forest:
    """Fits the forest on labelled documents that are not held out, at most ``max_rows`` of them.

    A row of ``labels`` without an id or a quality is ignored; ids that repeat count once, with the lower quality. Labels of absent
    documents teach nothing; of documents that share an id the first text in order teaches.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text")).select("y", "text")
    schema = "y double, " + ", ".join(f"{f} double" for f in FEATURES)
    sample = rows.mapInArrow(_features_of, schema).toPandas().to_numpy(np.float64)
    sample = sample[np.lexsort(sample.T[::-1])]  # the same order whichever task ended first
    return fit_forest(sample[:, 1:], sample[:, 0])


def score_quality(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id`` and ``score`` of every row; null and empty texts are scored as texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                score = forest.scores(text_features(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores ``CUT`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                good = forest.scores(text_features(part.column("text"))) >= CUT
                yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 if the score is ``CUT`` or more) of every row of ``docs``."""
    scored = score_quality(docs, fit_quality(docs, labels, max_rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
