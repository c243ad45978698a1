"""Quality rules: counts of words, symbols and repeats, then a log-likelihood ratio of hashed n-grams against the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm import kernels, runs
from tempoframe.llm.workspace import table

U = kernels.U
#: n-grams (words and pairs of words) are hashed into 2 ** BITS buckets.
BITS = 14
#: The target's multinomial is fitted on at most this many trusted rows, those with the smallest hashes of their ids.
MAX_TRUSTED = 20_000
#: Pseudo-count of a bucket in the target; the corpus gets as many in proportion to its size.
PRIOR = 16.0
#: A document is kept if its mean log-likelihood ratio, in millionths, reaches this.
CUT = -50_000
#: Fewest words, and the largest share of words in repeated windows in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_STARTS = (np.arange(256) & 0xC0) != 0x80
_LINES = np.arange(256) != 10
_PAIR, _TRIPLE = U(kernels._BASE), U(5)
_ROWS = 512


def buckets(words: np.ndarray) -> np.ndarray:
    """The buckets of all words and pairs of neighbours of a text, given its word hashes."""
    pairs = kernels.mix(words[:-1] * _PAIR + words[1:])
    return (np.concatenate([words, pairs]) >> U(64 - BITS)).astype(np.int64)


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three which the text holds twice or more."""
    if len(words) < 4:
        return 0
    windows = kernels.mix((words[:-2] * _TRIPLE + words[1:-1]) * _PAIR + words[2:])
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= twice
    return int(covered.sum())


def repeated_lines(raw: np.ndarray, word_starts: np.ndarray) -> int:
    """Lines with a word that equal an earlier line."""
    start, _, lines = runs.runs(raw, _LINES)
    if len(start) < 2:
        return 0
    with_words = np.unique(np.searchsorted(start, word_starts, "right") - 1)
    return len(with_words) - len(np.unique(lines[with_words]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's n-grams by bucket: of all its texts, and of the trusted ones."""
    size = 1 << BITS
    everything, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
        for at in range(0, batch.num_rows, _ROWS):
            for i, raw in enumerate(runs.texts(batch.slice(at, _ROWS).column("text"))):
                found = np.bincount(buckets(runs.runs(raw, runs.WORDS)[2]), minlength=size)
                everything += found
                if trusted[at + i]:
                    target += found
    used = np.flatnonzero(everything)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, everything[used], target[used])], names=["bucket", "corpus", "target"])


def fit_ratio(docs: DataFrame, trusted: DataFrame, max_trusted: int = MAX_TRUSTED) -> np.ndarray:
    """Log-likelihood ratio of every bucket in whole millionths: how much likelier an n-gram of it is in trusted documents than in the corpus.

    The corpus is every row of ``docs``; the target are its rows whose doc_id is in ``trusted``, a bounded sample of ids (``max_trusted``) with nulls and
    repeats left out. Tasks count on their own and only a row a bucket is added up. Without trusted rows all ratios are 0.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted).withColumn("trusted", F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id", "left")
    rows = rows.select(F.coalesce("trusted", F.lit(False)).alias("trusted"), "text")
    counts = rows.mapInArrow(_count, "bucket long, corpus long, target long").groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))
    found = counts.toPandas()  # a row a bucket at most
    corpus, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    place = found["bucket"].to_numpy(np.int64)
    corpus[place], target[place] = found["corpus"].to_numpy(np.float64), found["target"].to_numpy(np.float64)
    whole, part = corpus.sum(), target.sum()
    if not part:
        return np.zeros(1 << BITS, np.int64)
    return np.round(1_000_000 * np.log((target + PRIOR) * (whole / part) / (corpus + PRIOR * whole / part))).astype(np.int64)


def judged(docs: DataFrame, ratio: np.ndarray, cut: int = CUT) -> DataFrame:
    """Counts, rules and verdict of every row of ``docs``; see ``quality_rules``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                out = np.zeros((part.num_rows, 7), np.int64)
                for i, raw in enumerate(runs.texts(part.column(1))):
                    start, _, words = runs.runs(raw, runs.WORDS)
                    grams = buckets(words)
                    out[i] = (
                        len(words), np.count_nonzero(_STARTS[raw] & runs.WORDS[raw]), np.count_nonzero(_SYMBOLS[raw]), repeated_lines(raw, start),
                        repeated_words(words), len(grams), ratio[grams].sum(),
                    )
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in out.T)], names=["doc_id", *_COLUMNS])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COLUMNS)
    counts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    likely = F.col("total") >= cut * F.col("grams")
    mean = F.when(F.col("grams") > 0, F.col("total") / F.col("grams") / 1_000_000)
    return counts.select("doc_id", *_COLUMNS[:5], failed.alias("base_failed"), (~failed & likely).alias("kept"), mean.alias("log_ratio"))


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "grams", "total")


def quality_rules(docs: DataFrame, trusted: DataFrame, cut: int = CUT, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts, ``base_failed``, ``kept`` and ``log_ratio``.

    Words are maximal runs of other than ASCII white space, case kept. ``n_words``; ``word_chars``, code points in words; ``n_symbols``, characters of
    ``#*$%&|<>``; ``n_dup_lines``, lines with a word that equal an earlier line; ``n_repeat_words``, words in windows of three words that the text holds
    twice or more. A text of fewer than ``LEAST_WORDS`` words, or with over ``MOST_REPEATED`` percent of its words repeated, fails the base rules.
    Of the others those are kept whose mean log-likelihood ratio over all words and pairs of words, between the multinomials of ``trusted`` documents and of
    the whole corpus, is ``cut`` millionths or more; no document is judged by chance. ``log_ratio`` is null for texts without words.

    Null and empty texts have no words and fail. Repeated rows and rows without an id are judged like others; a trusted id that repeats in ``docs`` counts
    with all its rows. Other columns are ignored; an empty table gives no rows.
    """
    return judged(docs, fit_ratio(docs, trusted, max_trusted), cut)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and verdict for all documents; those that labels call good are the target."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules(table(spark, sf_dir, "documents"), good)


#: Word hashes in SQL: a polynomial over the bytes plus their number, and an avalanche, both modulo 2 ** 64.
_MOD, _MUL = "18446744073709551616::UHUGEINT", f"{kernels._BASE}::UHUGEINT"


def _sql_mix(x: str) -> str:
    """The avalanche of ``kernels.mix`` as three nested steps."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = f"((xor({x}, {x} >> {shift})::UHUGEINT * {factor}::UHUGEINT) % {_MOD})::UBIGINT"
    return x


ORACLE = {
    "op13_quality_rules": rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w0 AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
p AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM w0),
u AS (SELECT DISTINCT w FROM p),
b AS (SELECT w, list_reverse(list_transform(range(0, octet_length(encode(w))),
                             lambda k: ('0x' || substr(hex(encode(w)), 2 * k + 1, 2))::UHUGEINT + 1)) AS bytes FROM u),
h0 AS (SELECT w, ((list_reduce(bytes, lambda a, x: (a * {_MUL} + x) % {_MOD}) + len(bytes)::UHUGEINT) % {_MOD})::UBIGINT AS x FROM b),
h1 AS (SELECT w, {_sql_mix("x")} AS y FROM h0),
h AS (SELECT w, xor(y, y >> 31) AS h FROM h1),
ph AS (SELECT p.r, p.i, p.w, h.h FROM p JOIN h USING (w)),
g0 AS (SELECT r, h, ((h::UHUGEINT * {_MUL} + lead(h) OVER (PARTITION BY r ORDER BY i)) % {_MOD})::UBIGINT AS x FROM ph),
g1 AS (SELECT r, {_sql_mix("x")} AS y FROM g0 WHERE x IS NOT NULL),
g AS (SELECT r, h >> {64 - BITS} AS k FROM ph UNION ALL SELECT r, xor(y, y >> 31) >> {64 - BITS} AS k FROM g1),
good AS (SELECT r FROM t WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
c AS (SELECT k, count(*) AS corpus, count(good.r) AS target FROM g LEFT JOIN good USING (r) GROUP BY k),
s AS (SELECT sum(corpus)::DOUBLE AS whole, sum(target)::DOUBLE AS part FROM c),
l AS (SELECT k, round_even(1000000 * ln((target + {PRIOR}) * (whole / part) / (corpus + {PRIOR} * whole / part)), 0)::BIGINT AS v FROM c, s),
e AS (SELECT r, count(*) AS grams, sum(v)::BIGINT AS total FROM g JOIN l USING (k) GROUP BY r),
x AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) > 1 AS twice
      FROM (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE w3 IS NOT NULL),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM x WHERE twice) GROUP BY r),
ln AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, list_sum(list_transform(ws, lambda w: length(w)))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(ln.n, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(grams, 0) AS grams, coalesce(total, 0) AS total
  FROM w0 LEFT JOIN ln USING (r) LEFT JOIN rep USING (r) LEFT JOIN e USING (r))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND total >= {CUT} * grams AS kept,
       CASE WHEN grams > 0 THEN total / grams / 1000000 END AS log_ratio
FROM f
"""
}
