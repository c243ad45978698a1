"""Ranked lexical search: best-first document intervals, bounded by range-maximum sparse tables of posting lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm import runs
from tempoframe.llm.workspace import best_rows, new_path, staged, table

#: Documents returned for an item.
FIRST = 10
#: Postings of an index segment, and terms of the items that are searched for at a time.
SEGMENT_POSTINGS, PORTION_TERMS = 1 << 19, 1 << 20
#: Intervals split at once, and postings up to which an interval is summed outright.
SPLIT, LEAF = 64, 256
#: Rows of a batch that are read into lists at once.
_ROWS = 512


def _counted(vocabulary: np.ndarray | None, key: str):
    """``key``, the number of terms of a text, and its different terms with their counts: hashes, or, of those in the ``vocabulary``, their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                sizes, terms, times = [], [], []
                for raw in runs.texts(part.column(1)):
                    h = runs.runs(raw, runs.TERMS, fold=True)[2]
                    sizes.append(len(h))
                    if vocabulary is None:
                        h = h.view(np.int64)
                    else:
                        place = np.searchsorted(vocabulary, h)
                        place[place == len(vocabulary)] = 0
                        h = place[vocabulary[place] == h] if len(vocabulary) else place[:0]
                    different, n = np.unique(h, return_counts=True)
                    terms.append(different)
                    times.append(n)
                ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in terms]))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int64))) for x in (terms, times)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.asarray(sizes, np.int64)), *lists], names=[key, "n", "terms", "times"])

    return run


class _Segment:
    """Posting lists of some documents, in the order of their ids, with a sparse table of range maxima over every list."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc = np.repeat(place, np.diff(ends))
        self.ids, self.width = ids[order], len(ids)
        keys = terms * self.width + doc
        by = np.argsort(keys, kind="stable")
        self.keys, self.impacts, self.docs = keys[by], impacts[by], doc[by]
        self.terms, self.starts = np.unique(terms[by], return_index=True)
        self.stops = np.append(self.starts[1:], len(by))
        longest = int((self.stops - self.starts).max()) if len(by) else 1
        self.log = np.zeros(longest + 1, np.int64)
        for i in range(1, longest.bit_length()):
            self.log[1 << i :] = i
        # Level k holds the place of the largest of the 2^k postings from each place on; of equal ones the first.
        levels = [np.arange(len(by), dtype=np.int32)]
        for k in range(1, longest.bit_length()):
            below, step = levels[-1], 1 << (k - 1)
            left, right = below[:-step], below[step:]
            best = below.copy()
            best[:-step] = np.where(self.impacts[left] >= self.impacts[right], left, right)
            levels.append(best)
        self.table = np.stack(levels)

    def largest(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place and the impact of the largest posting from ``start`` up to ``stop``; an empty stretch has impact 0."""
        size = stop - start
        level = self.log[size]
        last = len(self.impacts) - 1
        one = self.table[level, np.minimum(start, last)]
        two = self.table[level, np.clip(stop - (1 << level), 0, last)]
        a, b = self.impacts[one], self.impacts[two]
        return np.where(a >= b, one, two), np.where(size > 0, np.maximum(a, b), 0)


class _First:
    """The first documents of an item so far: by descending score and ascending id."""

    __slots__ = ("ids", "k", "scores")

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores > 0 if len(self.scores) < self.k else scores >= self.scores[-1]
        if good.any():
            ids, scores = np.concatenate([self.ids, ids[good]]), np.concatenate([self.scores, scores[good]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.ids, self.scores = ids[first], scores[first]

    def open(self, bounds: np.ndarray, least_ids: np.ndarray) -> np.ndarray:
        """Whether an interval with such a bound and least id can hold one of the first documents."""
        if len(self.scores) < self.k:
            return bounds > 0
        return (bounds > self.scores[-1]) | ((bounds == self.scores[-1]) & (least_ids < self.ids[-1]))


def _search(seg: _Segment, terms: np.ndarray, times: np.ndarray, first: _First, split: int = SPLIT, leaf: int = LEAF) -> int:
    """Adds the segment's best documents for an item with these terms to ``first``; returns how many documents were scored."""
    at = np.searchsorted(seg.terms, terms)
    at[at == len(seg.terms)] = 0
    here = seg.terms[at] == terms
    at, times, base = at[here], times[here], terms[here] * seg.width
    if not len(at):
        return 0
    start, stop = seg.starts[at][None, :], seg.stops[at][None, :]
    low, high = np.zeros(1, np.int64), np.full(1, seg.width)
    best, impact = seg.largest(start, stop)
    parts = impact * times
    bound = parts.sum(axis=1)
    scored = 0
    while True:
        keep = np.flatnonzero(first.open(bound, seg.ids[np.minimum(low, seg.width - 1)]))
        if not len(keep):
            return scored
        low, high, start, stop, best, parts, bound = (x[keep] for x in (low, high, start, stop, best, parts, bound))
        order = np.argsort(-bound, kind="stable")
        now, later = order[:split], order[split:]
        nl, nh, ns, ne = low[now], high[now], start[now], stop[now]
        # The document of the largest impact in the interval divides it.
        lead = parts[now].argmax(axis=1)
        middle = seg.docs[best[now, lead]]
        # Intervals of few postings are summed outright.
        small = (ne - ns).sum(axis=1) <= leaf
        if small.any():
            sizes = (ne - ns)[small].ravel()
            where = np.repeat(ns[small].ravel(), sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            docs, sums = seg.docs[where], seg.impacts[where] * np.repeat(np.tile(times, int(small.sum())), sizes)
            different, back = np.unique(docs, return_inverse=True)
            total = np.zeros(len(different), np.int64)
            np.add.at(total, back, sums)
            first.add(seg.ids[different], total)
            scored += len(different)
        big = ~small
        nl, nh, ns, ne, middle = nl[big], nh[big], ns[big], ne[big], middle[big]
        wanted = base[None, :] + middle[:, None]
        cut = np.searchsorted(seg.keys, wanted)
        hit = seg.keys[np.minimum(cut, len(seg.keys) - 1)] == wanted
        total = np.where(hit, seg.impacts[np.minimum(cut, len(seg.keys) - 1)] * times, 0).sum(axis=1)
        first.add(seg.ids[middle], total)
        scored += len(middle)
        fresh = (np.concatenate([nl, middle + 1]), np.concatenate([middle, nh]), np.concatenate([ns, cut + hit]), np.concatenate([cut, ne]))
        b, i = seg.largest(fresh[2], fresh[3])
        p = i * times
        low, high, start, stop, best, parts, bound = (
            np.concatenate([x[later], y]) for x, y in zip((low, high, start, stop, best, parts, bound), (*fresh, b, p, p.sum(axis=1)), strict=True)
        )


def impacts_of(terms: np.ndarray, times: np.ndarray, n: np.ndarray, weights: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a posting adds to a score: w * ((1000000000 * tf) div (1000 * tf + 8 * m)), m = 25 + (75 * n * N) div L."""
    if len(n) and int(n.max()) * documents * 75 >= 1 << 62:
        n = n.astype(object)  # beyond 64 bits only between the two steps
    m = (25 + 75 * n * documents // length).astype(np.int64)
    return weights[terms] * (1_000_000_000 * times // (1000 * times + 8 * m))


def _ranked(items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, length: int, k: int, postings: int):
    """A task's first ``k`` documents of every item, segment after segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [_First(k) for _ in items]
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def search() -> None:
            ids, sizes, n, terms, times = (np.concatenate(x) for x in zip(*held, strict=True))
            each = impacts_of(terms, times, np.repeat(n, sizes), weights, documents, length)
            seg = _Segment(ids, np.concatenate(([0], np.cumsum(sizes))), terms, each)
            for best, (_, wanted, often) in zip(first, items, strict=True):
                _search(seg, wanted, often, best)

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                lists = part.column("terms")
                sizes = np.diff(lists.offsets.to_numpy())
                terms, times = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "times"))
                held.append((part.column("doc_id").to_numpy(), sizes, part.column("n").to_numpy(), terms, times))
                count += len(terms)
                if count >= postings:
                    search()
                    held, count = [], 0
        if count:
            search()
        columns = (
            [i for (i, _, _), b in zip(items, first, strict=True) for _ in b.ids], [d for b in first for d in b.ids], [s for b in first for s in b.scores],
        )
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], names=["item_id", "doc_id", "score"])

    return run


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = FIRST) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank`` (an int from 1), ``doc_id`` and ``score``, equal scores by ascending doc_id.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``. Terms are maximal runs of ASCII letters and digits and of characters beyond
    ASCII, with A-Z lower-cased. With N documents that have a term, L terms in all, n in a document, df documents that hold a term and tf of it in a
    document, w is floor(1000 * ln((2N + 2) / (2 df + 1))), m is 25 + (75 * n * N) div L, and a document scores the sum over the
    item's terms, repeats included, of w * ((1000000000 * tf) div (1000 * tf + 8 * m)); only scores above 0 are returned.

    Null and termless texts match nothing. Rows that repeat a doc_id are documents of their own; rows without one count in N, L and df but are not
    ranked. Rows that share an item_id are one item with the terms of all; rows without one are left out. Other columns are ignored;
    empty tables give no rows. Terms are told apart by 64-bit hashes.

    Whole documents are read once for every portion of items (one, up to ``PORTION_TERMS`` terms of all items), their counts of
    those terms are written, and tasks build index segments of ``SEGMENT_POSTINGS`` postings from them. For an item, a range-maximum sparse table over each
    posting list bounds what any document of an interval can score; the best interval is split at its document of the largest impact, which is scored, until no
    interval can hold a better one than the first ``k``, which a task carries from segment to segment.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    asked = asked.mapInArrow(_counted(None, "item_id"), "item_id long, n long, terms array<bigint>, times array<bigint>")
    asked = asked.select("item_id", F.inline(F.arrays_zip("terms", "times"))).groupBy("item_id", "terms").agg(F.sum("times").alias("times"))
    asked = staged(asked, "asked")
    portions = math.ceil(asked.count() / PORTION_TERMS)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = new_path(spark, "ranked")
    schema = "item_id long, doc_id long, score long"
    spark.createDataFrame([], schema + ", rank int").write.parquet(out)
    for portion in range(portions):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(portions)) == portion).orderBy("item_id", "terms").toPandas()  # bounded by PORTION_TERMS
        if not len(mine):
            continue
        hashes, place = np.unique(mine["terms"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        cuts = np.flatnonzero(np.diff(mine["item_id"].to_numpy(np.int64), prepend=mine["item_id"].iloc[0] - 1))
        wanted = zip(mine["item_id"].iloc[cuts], np.split(place, cuts[1:]), np.split(mine["times"].to_numpy(np.int64), cuts[1:]), strict=True)
        kept = source.mapInArrow(_counted(hashes, "doc_id"), "doc_id long, n long, terms array<bigint>, times array<bigint>").where("n > 0")
        kept = staged(kept, "postings")
        documents, length = kept.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        df = np.zeros(len(hashes), np.int64)
        held = kept.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).toPandas()  # a row a term of the portion
        df[held["t"].to_numpy(np.int64)] = held["n"].to_numpy(np.int64)
        weights = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * df + 1))).astype(np.int64)
        search = _ranked([(int(i), t, n) for i, t, n in wanted], weights, documents, length, k, SEGMENT_POSTINGS)
        local = kept.where("doc_id is not null and size(terms) > 0").mapInArrow(search, schema)
        best_rows(local, ["item_id"], [F.desc("score"), F.asc("doc_id")], k, "rank").write.mode("append").parquet(out)
    return spark.read.schema(schema + ", rank int").parquet(out).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""
ORACLE = {
    "op12_lexical_search": f"""
WITH d AS (SELECT doc_id, {_TERMS} FROM documents),
i AS (SELECT item_id, {_TERMS} FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS c FROM i GROUP BY item_id, term),
p AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM n),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (doc_id), g WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM r WHERE place <= 10
"""
}
