"""Benchmark decontamination: spaced seeds over token hashes, then substitution-tolerant overlaps around the hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.workspace import staged, table

#: Tokens of a compared window, substitutions that it may hold, and tokens of a block.
WINDOW, SUBSTITUTIONS, BLOCK = 12, 2, 3
#: A mask keeps two blocks and ignores this many tokens between them. A window of four blocks with two substitutions has
#: two clean blocks, and whichever two they are, one of these masks keeps them: nothing is missed.
MASKS = (0, 3, 6)
#: Index rows and document ids up to these counts are broadcast (about 32 MB each); beyond, they are shuffled.
BROADCAST_INDEX, BROADCAST_IDS = 1_000_000, 1_000_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def _hashed(df: DataFrame, key: str) -> DataFrame:
    """``key`` and the array ``h`` of token hashes, held behind a generator so that it is made once a row."""
    made = df.select(key, F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    return made.select(key, F.inline(F.array(F.struct("h")))).where(F.size("h") >= WINDOW)


def _seeds(hashed: DataFrame, key: str) -> DataFrame:
    """Masked hashes at every position: ``key``, ``gap``, ``at`` and ``seed``."""
    span = F.size("h") - (BLOCK - 1)
    block = F.transform(F.sequence(F.lit(0), span - 1), lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2)))
    blocks = hashed.select(key, F.inline(F.array(F.struct(F.size("h").alias("n"), block.alias("b")))))
    first = F.col("n") - (2 * BLOCK - 1)

    def masked(gap: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), first - gap - 1), lambda i: F.xxhash64(F.lit(gap), F.get("b", i), F.get("b", i + BLOCK + gap))
        )

    parts = [masked(g) for g in MASKS]
    rows = blocks.select(key, "n", F.posexplode(F.concat(*parts)).alias("k", "seed"))
    second = 2 * F.col("n") - 2 * (2 * BLOCK - 1) - 3
    gap = F.when(F.col("k") < first, 0).when(F.col("k") < second, 3).otherwise(6)
    at = F.when(F.col("k") < first, F.col("k")).when(F.col("k") < second, F.col("k") - first).otherwise(F.col("k") - second)
    return rows.select(key, "n", gap.alias("gap"), at.alias("at"), "seed")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Passages of benchmark items inside documents, with up to two substituted tokens in any twelve.

    Returns one row per document and item that share a window of ``WINDOW`` tokens with at most ``SUBSTITUTIONS``
    different ones: ``doc_id``, ``item_id``, ``n_windows`` (matching pairs of positions), ``first_token`` and
    ``end_token`` (the span in the document that matching windows cover), ``substitutions`` (least of any window).
    Tokens are lower-cased runs of letters and digits. Items with equal tokens are one, under their smallest id; rows
    that share a doc_id and tokens are one, and the windows of different texts of one id add up. Items of fewer than twelve tokens are found nowhere. Null texts, texts of fewer than twelve tokens and rows without an id match
    nothing; other columns are ignored; empty tables give no rows. Documents are read whole, at every position, and
    only the index of the benchmark is broadcast, if it is small enough.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    items = staged(_hashed(items, "item_id").groupBy("h").agg(F.min("item_id").alias("item_id")), "items")
    index = _seeds(items.select("item_id", "h"), "item_id").select(
        "item_id", F.col("n").alias("item_n"), F.col("at").alias("item_at"), "seed"
    )
    small = index.count() <= BROADCAST_INDEX
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    seen = _seeds(_hashed(source, "doc_id"), "doc_id").join(F.broadcast(index) if small else index, "seed")
    hits = staged(seen.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")

    ids = hits.select("doc_id").distinct()
    few = ids.count() <= BROADCAST_IDS
    chosen = _hashed(source.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), "doc_id")
    shifts = hits.groupBy("doc_id", "item_id").agg(F.collect_set("shift").alias("shifts"))  # a document has as many diagonals as tokens at most
    both = shifts.join(chosen.distinct(), "doc_id").join(items.withColumnRenamed("h", "g"), "item_id")
    found = both.select("doc_id", "item_id", F.inline(F.transform("shifts", _diagonal)))
    return (
        found.where("n > 0")
        .groupBy("doc_id", "item_id")
        .agg(
            F.sum("n").alias("n_windows"),
            F.min("first").cast("long").alias("first_token"),
            (F.max("last") + WINDOW).cast("long").alias("end_token"),
            F.min("bad").cast("long").alias("substitutions"),
        )
    )


def _diagonal(shift: Column) -> Column:
    """Of the windows on a diagonal of ``h`` and ``g`` with few enough substitutions: how many, the first and the last place in ``h``, and the fewest substitutions.

    Arrays are bound to names by mapping over a list of one, so that each is made once a diagonal; no window becomes a row.
    """
    low = F.greatest(shift, F.lit(0))
    high = F.least(F.size("h"), F.size("g") + shift) - 1
    differs = F.transform(F.sequence(low, high), lambda i: F.when(F.get("h", i) == F.get("g", i - shift), 0).otherwise(1))
    sums = lambda d: F.transform(F.sequence(F.lit(1), F.size(d) - WINDOW + 1), lambda i: F.aggregate(F.slice(d, i, WINDOW), F.lit(0), lambda a, x: a + x))
    good = lambda d: F.filter(F.transform(sums(d), lambda bad, i: F.struct(bad.alias("bad"), (low + i).alias("at"))), lambda w: w["bad"] <= SUBSTITUTIONS)
    told = lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.get(w, F.lit(0))["at"].alias("first"), F.get(w, F.size(w) - 1)["at"].alias("last"), F.array_min(w["bad"]).alias("bad")
    )
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.lit(None).cast("int").alias("bad"))
    return F.when(high - low + 1 >= WINDOW, F.get(F.transform(F.array(differs), lambda d: F.get(F.transform(F.array(good(d)), told), F.lit(0))), F.lit(0))).otherwise(none)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = {
    "op2_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' '),
                             lambda w: w <> '') AS ws FROM documents WHERE doc_id IS NOT NULL),
b0 AS (
  SELECT item_id, list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' '),
                              lambda w: w <> '') AS ws FROM benchmark WHERE item_id IS NOT NULL),
b AS (SELECT min(item_id) AS item_id, ws FROM b0 GROUP BY ws),
dw AS (SELECT doc_id, p, ws[p + 1 : p + 12] AS w FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 11)) AS p FROM d WHERE len(ws) >= 12)),
bw AS (SELECT item_id, p, ws[p + 1 : p + 12] AS w FROM (SELECT item_id, ws, unnest(range(0, len(ws) - 11)) AS p FROM b WHERE len(ws) >= 12)),
dk AS (SELECT doc_id, p, w, unnest([0, 3, 6, 9]) AS o FROM dw),
bk AS (SELECT item_id, p, w, unnest([0, 3, 6, 9]) AS o FROM bw),
c AS (
  SELECT DISTINCT dk.doc_id, bk.item_id, dk.p AS da, bk.p AS ba,
         len(list_filter(range(1, 13), lambda i: dk.w[i] <> bk.w[i])) AS bad
  FROM dk JOIN bk ON dk.o = bk.o AND dk.w[dk.o + 1] = bk.w[bk.o + 1] AND dk.w[dk.o + 2] = bk.w[bk.o + 2]
                 AND dk.w[dk.o + 3] = bk.w[bk.o + 3])
SELECT doc_id, item_id, count(*) AS n_windows, min(da) AS first_token, max(da) + 12 AS end_token, min(bad) AS substitutions
FROM c WHERE bad <= 2 GROUP BY doc_id, item_id
"""
}
