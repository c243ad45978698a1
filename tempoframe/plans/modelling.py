"""Queries over model tables, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempoframe.functions.expressions import rounded, rounded_sql
from tempoframe.operators import evaluation as eva
from tempoframe.operators import regression as reg
from tempoframe.plans.fixtures import on_tables

MODEL_ROWS = """
scored AS (
  SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS level, CAST(CAST(o_orderkey * 7919 % 2003 AS INT) AS DOUBLE) / 4000 - 0.2 AS actual,
         CAST(CAST((o_orderkey * 7919 % 2003 + o_orderkey * 31 % 997) AS INT) AS DOUBLE) / 6000 - 0.2 AS predicted,
         CASE WHEN o_orderkey % 9 > 0 THEN CAST(CAST(o_orderkey * 13 % 601 AS INT) AS DOUBLE) / 1000 - 0.3 END AS previous_log_change,
         CAST(CAST(o_custkey % 101 AS INT) AS DOUBLE) / 10 AS a1, CASE WHEN o_orderkey % 5 > 0 THEN CAST(CAST(o_orderkey * 17 % 211 AS INT) AS DOUBLE) / 50 END AS a2
  FROM orders)"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_tables(spark, sf_dir, f"WITH {MODEL_ROWS} SELECT * FROM scored")


def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of all rows."""
    return eva.chronological_split(_rows(spark, sf_dir), "day", 0.25).select("row_id", "part")


def impute_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared columns of all rows, by the statistics of rows before 1999."""
    made = eva.impute_standardize(_rows(spark, sf_dir), ["a1", "a2"], F.col("day") < "1999-01-01")
    return rounded(made.select("row_id", "a1", "a2"))


def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all rows' levels."""
    return eva.category_codes(_rows(spark, sf_dir), "level", F.col("level") != "5-LOW").select("row_id", "level_code")


#: Predictors and positions of the least squares below; the first position has no column of its own.
_SLOPES = {"predicted": "predicted", "a1": "a1", "a1_squared": "a1 * a1"}
_PLACES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def ols_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares of the actual values on three predictors, one the square of another, and positions."""
    rows = _rows(spark, sf_dir).withColumns({c: F.expr(e) for c, e in _SLOPES.items()})
    return rounded(reg.ols_robust(rows, "actual", list(_SLOPES), "level").select("term", "coefficient", "std_error"))


def _ols_sql() -> str:
    """Least squares by Gram-Schmidt: a term's coefficient is that of the target on what the other columns leave of its column."""
    names = ["intercept", *_SLOPES, *(f"position_{v}" for v in _PLACES[1:])]
    columns = ["1.0::DOUBLE", *_SLOPES.values(), *(f"(level = '{v}')::INT::DOUBLE" for v in _PLACES[1:])]
    ctes = [f"b AS (SELECT row_id, actual AS y, {', '.join(f'{e} AS x{i}' for i, e in enumerate(columns))} FROM scored)"]
    for j in range(len(columns)):
        order, source = [i for i in range(len(columns)) if i != j] + [j], "b"
        for step, pivot in enumerate(order):
            rest = [*(f"x{i}" for i in order[step + 1 :]), "y"]
            made = [f"{c} - x{pivot} * (sum({c} * x{pivot}) OVER () / sum(x{pivot} * x{pivot}) OVER ()) AS {c}" for c in rest]
            slope = f"sum(y * x{pivot}) OVER () / sum(x{pivot} * x{pivot}) OVER () AS slope, x{pivot} / sum(x{pivot} * x{pivot}) OVER () AS pull"
            done = [f"x{i}" for i in order[:step]]
            ctes.append(f"g{j}_{step} AS (SELECT row_id, {', '.join([*done, f'x{pivot}', *made, slope])} FROM {source})")
            source = f"g{j}_{step}"
    k = len(columns) - 1
    lever = " + ".join(f"x{i} * x{i} / sum(x{i} * x{i}) OVER ()" for i in range(k + 1))
    ctes.append(f"e AS (SELECT row_id, y / (1 - ({lever})) AS e FROM g{k}_{k})")
    parts = [
        f"SELECT '{n}' AS term, any_value(slope) AS coefficient, sqrt(sum(e * e * pull * pull)) AS std_error FROM g{j}_{k} JOIN e USING (row_id)" for j, n in enumerate(names)
    ]
    return f"WITH {MODEL_ROWS}, {', '.join(ctes)} {' UNION ALL '.join(parts)}"


def baseline_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baselines of all rows."""
    return rounded(eva.baseline_predictions(_rows(spark, sf_dir)).select("row_id", "zero_change", "previous_change"))


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of all rows."""
    return rounded(eva.regression_metrics(_rows(spark, sf_dir), "actual", "predicted"))


def calibration_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration of all rows."""
    return rounded(eva.calibration_deciles(_rows(spark, sf_dir), "actual", "predicted"))


def bootstrap_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resampled difference between prediction and no change."""
    rows = eva.baseline_predictions(_rows(spark, sf_dir)).select("row_id", "actual", "predicted", "zero_change")
    return eva.bootstrap_difference(rows, "actual", "predicted", "zero_change", 5000, key="row_id")


def interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of intervals around the predictions."""
    rows = _rows(spark, sf_dir).withColumns({"lower": F.col("predicted") - F.col("a1") / 50, "upper": F.col("predicted") + 0.1})
    return rounded(eva.interval_coverage(rows, "actual", "lower", "upper"))


def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the prediction against the baselines."""
    rows = eva.baseline_predictions(_rows(spark, sf_dir))
    mine = eva.regression_metrics(rows, "actual", "predicted")
    zero = eva.regression_metrics(rows, "actual", "zero_change").select(F.col("mae").alias("zero_mae"), F.col("direction_accuracy").alias("zero_direction"))
    prev = eva.regression_metrics(rows, "actual", "previous_change").select(F.col("mae").alias("ols_mae"))
    cover = eva.interval_coverage(rows.withColumns({"lower": F.col("predicted") - 0.1, "upper": F.col("predicted") + 0.1}), "actual", "lower", "upper")
    return eva.promotion_gate(mine.crossJoin(zero).crossJoin(prev).crossJoin(cover))  # one row each


QUERIES = (
    chronological_split, impute_standardize, category_codes, ols_robust, baseline_predictions, regression_metrics, calibration_deciles, bootstrap_difference,
    interval_coverage, promotion_gate,
)

_S = f"WITH {MODEL_ROWS}"
_CLASS = "CASE WHEN {0} > ln(1.1) THEN 1 WHEN {0} < ln(0.9) THEN -1 ELSE 0 END"
_METRICS = f"""SELECT count(*) AS n, avg(abs(p - a)) AS mae, exp(avg(abs(p - a))) - 1 AS approximate_mae, sqrt(avg(pow(p - a, 2))) AS rmse,
  1 - sum(pow(p - a, 2)) / (var_pop(a) * count(*)) AS r2, avg(({_CLASS.format('a')} = {_CLASS.format('p')})::INT) AS direction_accuracy, corr(ra, rp) AS spearman, avg(p - a) AS mean_error
  FROM (SELECT a, p, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS ra, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS rp
        FROM (SELECT actual AS a, %s AS p FROM scored) s) t"""

ORACLES = {
    "chronological_split": f"""{_S}, d AS (SELECT DISTINCT day FROM scored), k AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM d),
        cut AS (SELECT day FROM k WHERE i = least(n - 2, greatest(1, floor(n * 0.75)))) SELECT row_id, CASE WHEN s.day <= cut.day THEN 'train' ELSE 'test' END AS part FROM scored s, cut""",
    "impute_standardize": rounded_sql(f"""{_S}, m AS (SELECT quantile_cont(a1, 0.5) AS m1, quantile_cont(a2, 0.5) AS m2 FROM scored WHERE day < DATE '1999-01-01'),
        f AS (SELECT row_id, day, coalesce(a1, m1) AS a1, coalesce(a2, m2) AS a2 FROM scored, m),
        t AS (SELECT avg(a1) AS u1, stddev_pop(a1) AS s1, avg(a2) AS u2, stddev_pop(a2) AS s2 FROM f WHERE day < DATE '1999-01-01') SELECT row_id, (a1 - u1) / s1 AS a1, (a2 - u2) / s2 AS a2 FROM f, t""", ["a1", "a2"]),
    "category_codes": f"""{_S}, l AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS c, count(*) OVER () AS n FROM (SELECT DISTINCT level FROM scored WHERE level <> '5-LOW') d)
        SELECT row_id, coalesce(c, (SELECT max(n) FROM l)) AS level_code FROM scored s LEFT JOIN l ON l.level = s.level""",
    "ols_robust": rounded_sql(_ols_sql(), ["coefficient", "std_error"]),
    "baseline_predictions": rounded_sql(f"{_S} SELECT row_id, 0.0::DOUBLE AS zero_change, coalesce(previous_log_change, 0) AS previous_change FROM scored", ["zero_change", "previous_change"]),
    "regression_metrics": rounded_sql(f"{_S} {_METRICS % 'predicted'}", ["mae", "approximate_mae", "rmse", "r2", "direction_accuracy", "spearman", "mean_error"]),
    "calibration_deciles": rounded_sql(f"""{_S}, e AS (SELECT unnest(list_distinct(quantile_cont(predicted, {[k / 10 for k in range(11)]}))) AS e FROM scored),
        b AS (SELECT row_id, actual, predicted, greatest((SELECT count(*) FROM e WHERE e.e < s.predicted) - 1, 0) AS bin FROM scored s)
        SELECT bin, count(*) AS n, avg(predicted) AS mean_predicted, avg(actual) AS mean_actual, avg((actual > 0)::INT) AS share_rising FROM b GROUP BY bin""", ["mean_predicted", "mean_actual", "share_rising"]),
    "interval_coverage": rounded_sql(f"{_S} SELECT avg((actual BETWEEN predicted - a1 / 50 AND predicted + 0.1)::INT) AS coverage, quantile_cont(predicted + 0.1 - (predicted - a1 / 50), 0.5) AS median_width FROM scored", ["coverage", "median_width"]),
    "promotion_gate": f"""{_S}, m AS ({_METRICS % 'predicted'}), z AS ({_METRICS % '0.0::DOUBLE'}), o AS ({_METRICS % 'coalesce(previous_log_change, 0)'}),
        c AS (SELECT avg((actual BETWEEN predicted - 0.1 AND predicted + 0.1)::INT) AS v FROM scored),
        k AS (SELECT unnest([{{'c': 'beats_zero_mae', 'p': m.mae < z.mae}}, {{'c': 'beats_zero_direction', 'p': m.direction_accuracy > z.direction_accuracy}}, {{'c': 'beats_ols_mae', 'p': m.mae < o.mae}},
                    {{'c': 'positive_r2', 'p': m.r2 > 0}}, {{'c': 'coverage', 'p': c.v >= 0.8}}]) AS r FROM m, z, o, c)
        SELECT r.c AS "check", r.p AS passed, (SELECT bool_and(r.p) FROM k) AS promoted FROM k""",
}
