"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate edges, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm import kernels
from tempoframe.llm.graph import connected_components, local_components
from tempoframe.llm.workspace import join_counted, staged, table

BANDS, ROWS = 64, 8
#: Ids up to this many are sent to every executor (16 MB); beyond it the ids are joined by shuffling.
BROADCAST_IDS = 1_000_000
#: Members of a bucket that are compared as pairs; documents of a block where buckets are larger.
SMALL_BUCKET, BLOCK = 32, 512

_SKETCH = "doc_id long, n_shingles long, fp_hi long, fp_lo long, bands array<long>"
_SETS = "doc_id long, fp_hi long, fp_lo long, shingles array<long>"


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kernels.OnePermutation(BANDS, ROWS)
        for batch in batches:
            ids = batch.column(0)
            for lo, sets in _chunks(batch, words):
                full = [s for s in sets if len(s)]
                keys = iter(coder.keys(full)) if full else iter(())
                prints = [kernels.fingerprint(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([p[0] for p in prints], pa.int64()),
                        pa.array([p[1] for p in prints], pa.int64()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "fp_hi", "fp_lo", "bands"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, sets in _chunks(batch, words):
                prints = [kernels.fingerprint(s) for s in sets]
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, len(sets)),
                        pa.array([p[0] for p in prints], pa.int64()),
                        pa.array([p[1] for p in prints], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["doc_id", "fp_hi", "fp_lo", "shingles"],
                )

    return run


def _chunks(batch: pa.RecordBatch, words: int, most: int = 256) -> Iterator[tuple[int, list[np.ndarray]]]:
    lo, sets = 0, []
    for w in kernels.text_words(batch.column(1)):
        sets.append(kernels.shingle_set(w, words))
        if len(sets) == most:
            yield lo, sets
            lo, sets = lo + most, []
    if sets:
        yield lo, sets


def _dense_links(source: DataFrame, rows: DataFrame, words: int, threshold: int) -> DataFrame:
    """Spanning links (u, v) between members of different components that meet in large buckets.

    Buckets that share members form a family. A family is compared as a whole, so that pairs of many buckets are compared
    once, or bucket by bucket where that moves fewer sets, as in families that only a chain of buckets holds
    together. Either kind of group is cut into blocks of about ``BLOCK`` documents, and each pair of blocks is a task's
    group: it is bounded whatever the group's size.
    """
    star = rows.where("id <> head").select(F.col("head").alias("u"), F.col("id").alias("v")).distinct()
    family = staged(connected_components(star).select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "families")
    cost = lambda n: n * F.ceil(n / F.lit(float(BLOCK)))
    buckets = rows.groupBy("key").agg(F.min("head").alias("doc_id"), F.first("m").alias("m")).join(family, "doc_id")
    apart = buckets.groupBy("family").agg(F.sum(cost(F.col("m"))).alias("apart"))
    sized = family.groupBy("family").agg(F.count("*").alias("size")).join(apart, "family")
    sized = staged(sized.select("family", "size", (cost(F.col("size")) <= F.col("apart")).alias("whole")), "sized")
    label = rows.groupBy(F.col("id").alias("doc_id")).agg(F.min("c").alias("c"))
    one = family.join(sized.where("whole"), "family").select("doc_id", F.col("family").alias("group"), F.lit(True).alias("whole"), F.col("size").alias("m"))
    each = rows.join(buckets.join(sized.where("not whole"), "family").select("key"), "key").select(
        F.col("id").alias("doc_id"), F.col("key").alias("group"), F.lit(False).alias("whole"), "m"
    )
    plan = staged(one.unionAll(each).withColumn("blocks", F.ceil(F.col("m") / BLOCK)).join(label, "doc_id"), "plan")
    sets = _sets_of(source, plan.select("doc_id"), words).join(plan, "doc_id")
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    units = sets.select("doc_id", "c", "shingles", "group", "whole", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("k"))
    units = units.select("doc_id", "c", "shingles", "group", "whole", F.least("own", "k").alias("i"), F.greatest("own", "k").alias("j"))
    return units.groupBy("whole", "group", "i", "j").applyInPandas(_block_links(threshold), "u long, v long")


def _block_links(threshold: int):
    def links(unit: pd.DataFrame) -> pd.DataFrame:
        unit = unit.sort_values("doc_id", kind="stable").reset_index(drop=True)
        ids, c, sets = unit["doc_id"].to_numpy(), unit["c"].to_numpy(), unit["shingles"].tolist()
        sizes = np.array([len(s) for s in sets])
        vocabulary, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(len(sets)), sizes)
        shared = times[code] > 1  # a shingle of one document adds to no intersection
        doc, code = doc[shared], (np.cumsum(times > 1) - 1)[code[shared]]
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(code, kind="stable")
        doc, code = doc[order], code[order]
        for a in range(0, int((times > 1).sum()), 4096):
            lo, hi = np.searchsorted(code, [a, a + 4096])
            has = np.zeros((len(sets), 4096), np.float32)
            has[doc[lo:hi], code[lo:hi] - a] = 1
            both += has @ has.T
        near = (100 * both >= threshold * (sizes[:, None] + sizes[None, :] - both)) & (c[:, None] != c[None, :])
        u, v = np.nonzero(np.triu(near, 1))
        root = local_components(u, v, len(ids))
        leaf = root != np.arange(len(ids))
        return pd.DataFrame({"u": ids[root[leaf]], "v": ids[leaf]})

    return links


def _similar(threshold: int) -> Column:
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return 100 * shared >= threshold * (F.size("set_a") + F.size("set_b") - shared)


def near_duplicates(
    docs: DataFrame, words: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups documents whose sets of ``words``-word shingles have a Jaccard similarity of ``threshold`` percent or more.

    Returns one row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and
    ``kept`` (``doc_id = component_id``). Other columns of ``docs`` are ignored, whatever their names.
    A-Z are lower-cased and words are runs of anything but ASCII white space. Null and white-space texts have an empty
    set and link with nothing; a text of fewer words is one shingle. Equal sets are one class from the start, so that
    thousands of copies cost one signature. Rows that share a doc_id count as one document with all their links; a row
    without a doc_id links with nothing and has a null ``component_id`` and ``kept`` true. An empty table gives no rows.

    A class sends one key a band; a bucket's members are compared with its smallest member first (as many pairs as
    members). Members that are in one component by then need no more. In what is left of a bucket, members of different
    components are compared with each other, so no candidate link is lost: in small buckets as pairs of fitting sizes,
    at most half of ``SMALL_BUCKET`` a member; families of large buckets block by block inside tasks, which emit a
    spanning forest of the links and no pairs.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = staged(source.mapInArrow(_sketch(words), _SKETCH), "sketch")
    fp = ["fp_hi", "fp_lo"]
    filled = sketch.where("doc_id is not null and n_shingles > 0")
    classes = staged(filled.groupBy(*fp).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # Documents that link with nothing stay out of the joins, where they would all have one (null) key.
    alone = sketch.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    # Rows of one doc_id with different sets: their classes are linked.
    several = filled.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    parts = staged(filled.join(several, "doc_id", "left_semi").select("doc_id", *fp).distinct().join(classes, fp).select("doc_id", "rep"), "parts")
    same = parts.join(parts.groupBy("doc_id").agg(F.min("rep").alias("u")), "doc_id").select("u", F.col("rep").alias("v"))
    reps = (
        sketch.where("n_shingles > 0")
        .join(classes.select(F.col("rep").alias("doc_id"), *fp), ["doc_id", *fp])
        .dropDuplicates(["doc_id", *fp])
    )
    rows = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    heads = rows.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("other")).where("head <> other")
    buckets = staged(rows.join(heads.select("key", "head").hint("shuffle_hash"), "key"), "buckets")

    stars = buckets.where("id <> head").select(F.col("head").alias("u"), F.col("id").alias("v")).distinct()
    links = _confirmed(source, stars, words, threshold)
    found = connected_components(links)

    # What the stars leave: buckets that still hold several components.
    label = F.coalesce(F.col("component"), F.col("id")).alias("c")
    placed = buckets.join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", "head", label)
    mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    left = staged(placed.join(mixed.select("key", "m").hint("shuffle_hash"), "key"), "left")
    few, many = left.where(F.col("m") <= SMALL_BUCKET), left.where(F.col("m") > SMALL_BUCKET)
    fits = (100 * F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n")) & (F.col("a.c") != F.col("b.c"))
    rest = (
        few.alias("a")
        .join(few.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & fits)
        .where("a.id <> a.head")
        .select(F.col("a.id").alias("u"), F.col("b.id").alias("v"))
        .distinct()
    )
    more = _confirmed(source, rest, words, threshold)
    known = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
    found = connected_components(known.unionAll(more).unionAll(_dense_links(source, many, words, threshold)).unionAll(same))
    component = F.coalesce("component", "rep").alias("component_id")
    named = staged(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*fp, "copies", component), "named")
    linked = join_counted(filled.select("doc_id", "n_shingles", *fp), named, fp).select("doc_id", "n_shingles", "component_id")
    out = linked.unionAll(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _sets_of(source: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``doc_id`` and the distinct shingle sets of the documents in ``ids``."""
    wanted = staged(ids.distinct(), "wanted")
    small = wanted.count() <= BROADCAST_IDS
    chosen = source.join(F.broadcast(wanted) if small else wanted, "doc_id", "left_semi")
    return chosen.mapInArrow(_sets(words), _SETS).dropDuplicates(["doc_id", "fp_hi", "fp_lo"]).select("doc_id", "shingles")


def _confirmed(source: DataFrame, pairs: DataFrame, words: int, threshold: int) -> DataFrame:
    """Those pairs (u, v) whose full sets are similar."""
    pairs = staged(pairs, "pairs")
    sets = staged(_sets_of(source, pairs.select(F.explode(F.array("u", "v")).alias("doc_id")), words), "sets")
    return (
        pairs.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("set_b")), "v")
        .join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("set_a")), "u")
        .where(_similar(threshold))
        .select("u", "v")
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents: four-word shingles, similarity of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, threshold=80)


ORACLE = {
    "op10_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [list_aggregate(ws, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3]) END) AS g FROM w),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS u, doc_id AS c FROM n UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.u)
SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id, n.doc_id = m.c AS kept
FROM n JOIN (SELECT u, min(c) AS c FROM r GROUP BY u) m ON m.u = n.doc_id
"""
}
