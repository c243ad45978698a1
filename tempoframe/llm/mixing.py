"""Mixing: iterative proportional fitting of token weights to source, language and topic marginals, then sampling."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.llm.workspace import staged, table

DIMENSIONS = ("source", "lang", "topic")
#: Without targets of its own a category's target is its share of tokens raised to this power, which lifts small categories.
TEMPER = {"source": 0.5, "lang": 0.5, "topic": 0.7}
#: Most rounds over the three marginals, and the deviation at which they end.
SWEEPS, TOLERANCE = 40, 1e-12
#: Deviation of a marginal from given targets that is an error once the rounds are over.
MISSED = 1e-6
#: Cells (source, language and topic together) up to this many are raked in memory; more are raked by joins.
MAX_CELLS = 200_000
LONG_TEXT = 1000

Targets = Mapping[str, Mapping[str, float]]

_WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column, tokens: Column) -> Column:
    """A coarse kind of text, the first rule that holds; callers with a topic model of their own give its column instead."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return (
        F.when(low.contains("license"), "legal")
        .when(low.contains("@"), "contact")
        .when(low.contains("http"), "web")
        .when(tokens >= LONG_TEXT, "long")
        .otherwise("prose")
    )


def _with_dimensions(docs: DataFrame, topic_of: Callable[[Column, Column], Column]) -> DataFrame:
    """``docs`` with ``_mix_tokens`` and the three dimensions as ``_mix_source``, ``_mix_lang`` and ``_mix_topic``; the words of a text are counted once."""
    named = {f"_mix_{c}": F.coalesce(F.col(c).cast("string"), F.lit("(none)")) for c in ("source", "lang")}
    counted = docs.withColumns({"_mix_tokens": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD)).cast("long"), **named})
    return counted.withColumn("_mix_topic", F.coalesce(topic_of(F.col("text"), F.col("_mix_tokens")).cast("string"), F.lit("(none)")))


_MEASURES = ("tokens", *DIMENSIONS)


def measured(docs: DataFrame, topic_of: Callable[[Column, Column], Column] = topic) -> DataFrame:
    """``doc_id``, ``tokens`` and the three dimensions of every row; a null category is '(none)', a null text has no tokens."""
    made = _with_dimensions(docs.select("doc_id", "text", "source", "lang"), topic_of)
    return made.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(f"_mix_{c}").alias(c) for c in _MEASURES))


def _goal(names: list[str], shares: np.ndarray, temper: float, targets: Mapping[str, float] | None) -> np.ndarray:
    raised = np.array([max(0.0, targets.get(n, 0.0)) for n in names]) if targets else np.where(shares > 0, shares, 0) ** temper * (shares > 0)
    if not raised.sum() > 0:
        raise ValueError("none of the target weights is of a category that has tokens")
    return raised / raised.sum()


def _checked(off: float, given: bool) -> None:
    if given and off > MISSED:
        raise ValueError(f"the targets contradict one another: a marginal is still {off:.3g} away from its target")


def _raked(cells: pd.DataFrame, goal_of: Callable[[str, list[str], np.ndarray], np.ndarray], sweeps: int, given: bool) -> np.ndarray:
    """Weights of the cells (summing to one) once they meet the marginals, or after ``sweeps`` rounds, in memory."""
    w = cells["tokens"].to_numpy(np.float64) / cells["tokens"].sum()
    names, codes = zip(*(np.unique(cells[d], return_inverse=True) for d in DIMENSIONS), strict=True)
    goals = [goal_of(d, n.tolist(), np.bincount(c, w)) for d, n, c in zip(DIMENSIONS, names, codes, strict=True)]
    for _ in range(sweeps):
        for goal, code in zip(goals, codes, strict=True):
            now = np.bincount(code, w)
            w = w * np.divide(goal, now, out=np.zeros_like(now), where=now > 0)[code]
        off = max(np.abs(np.bincount(c, w) - g).max() for g, c in zip(goals, codes, strict=True))
        if off <= TOLERANCE:
            break
    _checked(off, given)
    return w


def _raked_frames(cells: DataFrame, goal_of: Callable[[str, list[str], np.ndarray], np.ndarray], sweeps: int, given: bool) -> DataFrame:
    """The same weights by aggregates and joins, every round written to the shared folder; goals are rows of one dimension, so they are small."""
    total = cells.agg(F.sum("tokens")).first()[0]
    w = cells.withColumn("w", F.col("tokens") / F.lit(float(total)))
    goal = {}
    for d in DIMENSIONS:
        now = w.groupBy(d).agg(F.sum("w").alias("s")).toPandas().sort_values(d)
        now["g"] = goal_of(d, now[d].tolist(), now["s"].to_numpy())
        goal[d] = cells.sparkSession.createDataFrame(now[[d, "g"]].values.tolist(), f"{d} string, g double")
    for _ in range(sweeps):
        for d in DIMENSIONS:
            factor = w.groupBy(d).agg(F.sum("w").alias("s")).join(goal[d], d).select(d, F.when(F.col("s") > 0, F.col("g") / F.col("s")).otherwise(0.0).alias("f"))
            w = w.join(factor, d).withColumn("w", F.col("w") * F.col("f")).drop("f")
        w = staged(w, "raked")
        off = [w.groupBy(d).agg(F.sum("w").alias("s")).join(goal[d], d).agg(F.max(F.abs(F.col("s") - F.col("g")))).first()[0] for d in DIMENSIONS]
        if max(off) <= TOLERANCE:
            break
    _checked(max(off), given)
    return w


def _scaled(ratio: np.ndarray, share: np.ndarray, weight: np.ndarray, keep: float) -> float:
    """The factor f for which documents kept with probability min(1, f * ratio) hold ``keep`` of all tokens at the mean."""
    order = np.argsort(-ratio, kind="stable")
    r, s, w = ratio[order], share[order], weight[order]
    full = np.concatenate(([0.0], np.cumsum(s)[:-1]))
    rest = w.sum() - np.concatenate(([0.0], np.cumsum(w)[:-1]))
    f = np.divide(keep - full, rest, out=np.full(len(r), np.inf), where=rest > 1e-15)
    return float(f[np.argmax(r * f <= 1)] if (r * f <= 1).any() else 1 / r[r > 0].min())


def _search(good: Callable[[float], bool], high: float) -> float:
    """The largest factor up to ``high`` (to 60 halvings) that is still good; small ones are."""
    low = 0.0
    for _ in range(60):
        f = (low + high) / 2
        low, high = (f, high) if good(f) else (low, f)
    return low


def _plan(rows: DataFrame, keep: float | None, unmet: float, targets: Targets | None, temper: Mapping[str, float], sweeps: int, max_cells: int) -> DataFrame:
    """``q`` of each cell: the tokens that it is due for each token that it has, and so its probability where that is below one."""
    spark = rows.sparkSession
    goal_of = lambda d, names, shares: _goal(names, shares, temper[d], (targets or {}).get(d))
    cells = staged(rows.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    count = cells.count()
    if count > max_cells:
        raked = _raked_frames(cells, goal_of, sweeps, bool(targets))
        total = float(cells.agg(F.sum("tokens")).first()[0])
        curve = staged(raked.select(*DIMENSIONS, (F.col("w") * F.lit(total) / F.col("tokens")).alias("r"), (F.col("tokens") / F.lit(total)).alias("s"), "w"), "curve")
        held = lambda f: curve.agg(F.sum(F.least(F.lit(1.0), F.col("r") * F.lit(f)) * F.col("s"))).first()[0]
        top = 1 / curve.where("r > 0").agg(F.min("r")).first()[0]
        factor = _search(lambda f: held(f) <= keep if keep is not None else held(f) >= f * (1 - unmet), top)
        return curve.select(*DIMENSIONS, (F.col("r") * F.lit(factor)).alias("q"))
    pdf = cells.toPandas().sort_values(list(DIMENSIONS)).reset_index(drop=True)  # at most max_cells rows
    pdf["q"] = 0.0
    if count:
        w = _raked(pdf, goal_of, sweeps, bool(targets))
        share = pdf["tokens"].to_numpy(np.float64) / pdf["tokens"].sum()
        r = w / share
        if keep is not None:
            factor = _scaled(r, share, w, keep)
        else:
            factor = _search(lambda f: (np.minimum(1, f * r) * share).sum() >= f * (1 - unmet), 1 / r[r > 0].min())
        pdf["q"] = factor * r
    return F.broadcast(spark.createDataFrame(pdf[[*DIMENSIONS, "q"]].values.tolist(), "source string, lang string, topic string, q double"))


def _draw(key: Column) -> Column:
    """A number in [0, 1) that follows from the key alone."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def mixed(
    docs: DataFrame, keep: float | None = 0.5, unmet: float = 0.01, targets: Targets | None = None, temper: Mapping[str, float] = TEMPER,
    sweeps: int = SWEEPS, max_cells: int = MAX_CELLS, topic_of: Callable[[Column, Column], Column] = topic,
) -> DataFrame:
    """Sampling decisions that bring the token mix of ``docs`` to the target marginals.

    ``targets`` gives the weights of categories by dimension (``source``, ``lang``, ``topic``; a category that is not named gets none);
    a dimension without targets takes its own shares, tempered. ``topic_of`` makes the topic of text and tokens.

    Returns one row per input row: ``doc_id``, ``tokens``, ``topic``, ``probability`` of being kept, ``weight`` (at least
    one: what a kept token counts where its cell would need more tokens than there are) and ``kept``. The mean of
    probability times weight meets all three marginals; kept documents hold ``keep`` of the tokens at the mean. With
    ``keep`` None it is as much as leaves at most ``unmet`` of the target weight to such cells, so that kept tokens meet
    the marginals without weights. Given targets that contradict one another where cells are empty, so that they are not met after ``sweeps``
    rounds, raise a ValueError; tempered shares that do are met in the last dimension.

    The decision depends on the id alone (md5), so equal ids fall alike; a null id counts as empty text. Documents without
    tokens weigh nothing and are kept. Null categories are '(none)'. An empty table gives no rows.
    """
    rows = staged(measured(docs, topic_of), "measured")
    plan = _plan(rows, keep, unmet, targets, temper, sweeps, max_cells)
    q = F.coalesce("q", F.lit(1.0))
    p = F.least(q, F.lit(1.0))
    kept = _draw(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) < p
    return rows.join(plan, list(DIMENSIONS), "left").select(
        "doc_id", "tokens", "topic", F.round(p, 9).alias("probability"), F.round(F.greatest(q, F.lit(1.0)), 6).alias("weight"), kept.alias("kept")
    )


def sampled(
    docs: DataFrame, keep: float | None = None, unmet: float = 0.01, targets: Targets | None = None, temper: Mapping[str, float] = TEMPER,
    sweeps: int = SWEEPS, max_cells: int = MAX_CELLS, topic_of: Callable[[Column, Column], Column] = topic,
) -> DataFrame:
    """The rows of ``docs`` that ``mixed`` keeps, with all their columns.

    Rows without a doc_id are drawn by their text, so that they do not all fall alike; equal ids fall alike. No text is shuffled.
    Column names that begin with ``_mix_`` are not allowed.
    """
    rows = staged(_with_dimensions(docs, topic_of), "measured")  # texts are read once more, but their words are not counted again
    plan = _plan(rows.select(*(F.col(f"_mix_{c}").alias(c) for c in _MEASURES)), keep, unmet, targets, temper, sweeps, max_cells)
    plan = plan.select(*(F.col(d).alias(f"_mix_{d}") for d in DIMENSIONS), F.col("q").alias("_mix_q"))
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.col("text"), F.lit(""))
    p = F.least(F.coalesce("_mix_q", F.lit(1.0)), F.lit(1.0))
    joined = rows.join(plan, [f"_mix_{d}" for d in DIMENSIONS], "left")
    return joined.where(_draw(key) < p).select(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling decisions for all documents: half of the tokens, in the tempered mix."""
    return mixed(table(spark, sf_dir, "documents"), keep=0.5)


def _oracle() -> str:
    sweep, last = [], "w0"
    for k in range(SWEEPS):
        for j, d in enumerate(DIMENSIONS):
            name = f"w{k * 3 + j + 1}"
            sweep.append(
                f"{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, c.w * g.g / sum(c.w) OVER (PARTITION BY c.{d}) AS w"
                f" FROM {last} c JOIN goal_{d} g ON g.{d} = c.{d})"
            )
            last = name
    goals = ", ".join(
        f"goal_{d} AS MATERIALIZED (SELECT {d}, pow(sum(w), {TEMPER[d]}) / sum(pow(sum(w), {TEMPER[d]})) OVER () AS g FROM w0 GROUP BY {d})"
        for d in DIMENSIONS
    )
    return rf"""
WITH rows0 AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, lower(coalesce(text, '')) AS low,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS tokens FROM documents),
docs AS MATERIALIZED (
  SELECT doc_id, source, lang, tokens, CASE WHEN contains(low, 'license') THEN 'legal' WHEN contains(low, '@') THEN 'contact'
         WHEN contains(low, 'http') THEN 'web' WHEN tokens >= {LONG_TEXT} THEN 'long' ELSE 'prose' END AS topic FROM rows0),
w0 AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE / sum(sum(tokens)) OVER () AS w
  FROM docs WHERE tokens > 0 GROUP BY source, lang, topic),
{goals},
{", ".join(sweep)},
ratio AS (SELECT *, tokens / sum(tokens) OVER () AS s, w / (tokens / sum(tokens) OVER ()) AS r FROM {last}),
steps AS (
  SELECT *, (0.5 - coalesce(sum(s) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS f
  FROM ratio WINDOW before AS (ORDER BY r DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pick AS (SELECT arg_max(f, r) AS f FROM steps WHERE r * f <= 1),
plan AS (SELECT source, lang, topic, r * pick.f AS q FROM ratio, pick),
drawn AS (
  SELECT d.*, coalesce(q, 1.0) AS q, ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM docs d LEFT JOIN plan p ON p.source = d.source AND p.lang = d.lang AND p.topic = d.topic)
SELECT doc_id, tokens, topic, round(least(q, 1.0), 9) AS probability, round(greatest(q, 1.0), 6) AS weight, u < least(q, 1.0) AS kept
FROM drawn"""


ORACLE = {"op5_mixing": _oracle()}
