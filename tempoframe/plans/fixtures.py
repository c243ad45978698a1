"""Projections of the given tables to the shapes that the operators read, in SQL that Spark and DuckDB both accept."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("events", "orders", "lineitem", "customer", "supplier", "nation", "region", "part", "documents", "pages", "labels")

PROJECTIONS = {
    "match_events": """
WITH a AS (
  SELECT event_id, user_id, CAST(floor(event_id / 500) AS BIGINT) AS match_id, event_id % 500 AS k,
         CAST(round(value * 100) AS BIGINT) AS v
  FROM events),
b AS (
  SELECT *, 1 + (CAST(floor(k / 6) AS BIGINT) + CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END) % 2 AS team_id,
         CASE WHEN k < 250 THEN 1 ELSE 2 END AS period_value,
         11 * k - 8 * (k % 4) AS event_time_seconds, (user_id * 3 + event_id * 7) % 20 AS tcode
  FROM a)
SELECT match_id, event_id, team_id, (team_id - 1) * 11 + 1 + user_id % 11 AS player_id, period_value,
       event_time_seconds,
       CASE WHEN tcode < 9 THEN 'Pass' WHEN tcode = 9 THEN 'TakeOn' WHEN tcode = 10 THEN 'Tackle'
            WHEN tcode = 11 THEN 'Interception' WHEN tcode = 12 THEN 'Clearance' WHEN tcode = 13 THEN 'BallRecovery'
            WHEN tcode = 14 THEN 'Foul' WHEN tcode = 15 THEN 'Challenge' WHEN tcode = 16 THEN 'SavedShot'
            WHEN tcode = 17 THEN 'MissedShots' WHEN tcode = 18 THEN 'Goal' ELSE 'Card' END AS type_name,
       CASE WHEN event_id % 4 = 0 THEN 'Unsuccessful' ELSE 'Successful' END AS outcome_name,
       CAST((v * 17 + event_id * 13) % 10000 AS DOUBLE) / 100 AS x,
       CAST((v * 29 + event_id * 7) % 10000 AS DOUBLE) / 100 AS y,
       CAST(((v * 17 + event_id * 13) % 10000 + v * 11 % 2000) % 10000 AS DOUBLE) / 100 AS end_x,
       CAST((v * 31 + event_id * 3) % 10000 AS DOUBLE) / 100 AS end_y,
       CAST(floor(event_time_seconds / 60) AS BIGINT) AS expanded_minute, event_time_seconds % 60 AS event_second,
       CASE WHEN tcode BETWEEN 16 AND 18 THEN 1 ELSE 0 END AS is_shot, CASE WHEN tcode = 18 THEN 1 ELSE 0 END AS is_goal,
       CASE WHEN tcode = 18 AND v % 29 = 0 THEN 1 ELSE 0 END AS is_own_goal,
       CASE WHEN tcode BETWEEN 16 AND 18 AND event_id % 3 > 0 THEN event_id - 1 END AS related_event_id,
       CASE WHEN tcode BETWEEN 16 AND 18 THEN CAST(v % 97 AS DOUBLE) / 100 END AS xg_given,
       CASE WHEN tcode IN (16, 18) THEN CAST(45 + v % 11 AS DOUBLE) END AS goal_mouth_y,
       CASE WHEN tcode IN (16, 18) THEN CAST(v % 38 AS DOUBLE) END AS goal_mouth_z,
       CASE WHEN tcode = 19 THEN CASE v % 5 WHEN 0 THEN 'Red' WHEN 1 THEN 'Second Yellow' ELSE 'Yellow' END END AS card_type,
       CASE v % 12 WHEN 0 THEN 'corner' WHEN 1 THEN 'free_kick' WHEN 2 THEN 'throw_in' WHEN 3 THEN 'goal_kick'
            WHEN 4 THEN 'cross' WHEN 5 THEN 'through_ball' WHEN 6 THEN 'long_ball' ELSE 'open' END AS pass_kind,
       CASE WHEN v % 7 = 0 THEN 1 ELSE 0 END AS is_key_pass, CASE WHEN v % 21 = 0 THEN 1 ELSE 0 END AS is_assist,
       CASE v % 4 WHEN 0 THEN 'Head' WHEN 1 THEN 'LeftFoot' WHEN 2 THEN 'RightFoot' ELSE 'OtherBodyPart' END AS body_part,
       CASE v % 8 WHEN 0 THEN 'Penalty' WHEN 1 THEN 'FromCorner' WHEN 2 THEN 'SetPiece' WHEN 3 THEN 'FastBreak' ELSE 'RegularPlay' END AS situation
FROM b
""",
    "player_ratings": """
SELECT o_custkey AS player_id, l_orderkey AS match_id, CAST(min(o_orderdate) AS DATE) AS match_date,
       CAST(sum(CAST(round(l_quantity) AS BIGINT)) % 91 AS DOUBLE) AS minutes,
       1 + CAST(sum(CAST(round(l_extendedprice) AS BIGINT)) % 900 AS DOUBLE) / 100 AS rating,
       CASE WHEN l_orderkey % 4 = 0 THEN 'Defender' WHEN l_orderkey % 4 = 1 THEN 'Midfielder' ELSE 'Forward' END AS position_group
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_orderkey
""",
    "rated_matches": """
SELECT o_custkey AS player_id, l_orderkey * 8 + l_linenumber AS match_id, match_date, 'P-' || CAST(o_custkey % 40 AS VARCHAR(9)) AS player_name,
       CASE WHEN part % 6 = 0 THEN NULL WHEN part % 3 = 0 THEN 'Defender' WHEN part % 3 = 1 THEN 'Midfielder' ELSE 'Forward' END AS position_group,
       CASE WHEN l_linenumber % 3 > 0 THEN 1 WHEN l_linenumber % 6 > 0 THEN 0 END AS started,
       CASE WHEN supp % 17 > 0 THEN CAST(CAST(round(quantity) AS BIGINT) * 7 % 126 AS DOUBLE) END AS minutes,
       CASE WHEN (l_orderkey + l_linenumber) % 13 > 0 THEN 1 + CAST(CAST(round(price) AS BIGINT) % 900 AS DOUBLE) / 100 END AS rating,
       CASE WHEN part % 7 > 0 THEN CAST(part % 3 AS DOUBLE) END AS goals, CAST(supp % 2 AS DOUBLE) AS assists,
       CAST(part % 97 AS DOUBLE) / 100 AS xg, CAST(part % 89 AS DOUBLE) / 100 AS xgot, CAST(supp % 83 AS DOUBLE) / 100 AS xa,
       CAST(supp % 3 AS DOUBLE) AS big_chances_missed, CAST(supp % 71 AS DOUBLE) / 100 AS big_chance_xg_missed, CASE WHEN part % 50 = 49 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS own_goals,
       CAST(part % 31 AS DOUBLE) / 10 AS threat_component, CAST(part % 29 AS DOUBLE) / 10 AS creation_component,
       CASE WHEN part % 5 > 0 THEN CAST(part % 23 AS DOUBLE) / 10 END AS progression_component, CAST(supp % 19 AS DOUBLE) / 10 AS retention_component,
       CAST(supp % 17 AS DOUBLE) / 10 AS attacking_xpv_component, CAST(supp % 13 AS DOUBLE) / 10 AS defensive_component, CAST(supp % 11 AS DOUBLE) / 10 AS finishing_component
FROM (
  SELECT o_custkey, l_orderkey, l_linenumber, CAST(max(l_shipdate) AS DATE) AS match_date, max(l_quantity) AS quantity, max(l_extendedprice) AS price, max(l_partkey) AS part, max(l_suppkey) AS supp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_orderkey, l_linenumber) t
""",
    "player_valuations": """
SELECT player_id, valuation_date, market_value, CAST(17 + player_id % 16 AS DOUBLE) + CAST(year(valuation_date) - 1992 AS DOUBLE) AS age_at_valuation
FROM (
  SELECT o_custkey AS player_id, CAST(o_orderdate AS DATE) AS valuation_date, max(CAST(round(o_totalprice) AS BIGINT)) AS market_value
  FROM orders WHERE o_totalprice > 0
  GROUP BY o_custkey, CAST(o_orderdate AS DATE)) t
""",
    "value_grid": """
SELECT z AS zone, CAST((z % 12 + 1) * (z % 12 + 1) * (4 + CASE WHEN floor(z / 12) IN (3, 4) THEN 3 ELSE 0 END) AS DOUBLE) / 10000 AS grid_value
FROM (SELECT DISTINCT event_id AS z FROM events WHERE event_id < 96) t
""",
    "player_matches": """
SELECT match_id, team_id, player_id,
       CASE WHEN (player_id + match_id) % 11 < 9 THEN 1 ELSE 0 END AS started,
       CASE WHEN (player_id + match_id) % 11 >= 9 THEN 'Sub' WHEN (player_id - 1) % 11 = 0 THEN 'GK'
            WHEN (player_id - 1) % 11 < 5 THEN 'DC' WHEN (player_id - 1) % 11 < 8 THEN 'MC' ELSE 'FW' END AS position_code,
       CASE WHEN (player_id * 7 + match_id) % 5 > 0 THEN CAST(1 + (player_id * 13 + match_id * 7) % 90 AS DOUBLE) END AS minutes
FROM (SELECT DISTINCT match_id, team_id, player_id FROM match_events) t
""",
    "substitutions": """
SELECT match_id, team_id, player_id, 'SubstitutionOn' AS type_name, 46 + player_id % 40 AS event_minute,
       CASE WHEN (player_id - 1) % 11 = 0 THEN player_id + 10 ELSE player_id - 1 END AS related_player_id
FROM player_matches WHERE started = 0
""",
}


def _needed(names: tuple[str, ...]) -> list[str]:
    """The projections that ``names`` build on, in order."""
    wanted: list[str] = []
    for name in names:
        for other in PROJECTIONS:
            if other != name and re.search(rf"\b{other}\b", PROJECTIONS[name]):
                wanted += [x for x in _needed((other,)) if x not in wanted]
        if name not in wanted:
            wanted.append(name)
    return wanted


def ctes(*names: str) -> str:
    """``WITH`` clauses of projections and what they build on, without the keyword."""
    return ",\n".join(f"{n} AS ({PROJECTIONS[n].strip()})" for n in _needed(names))


#: Line items that a part of what is made of them stands for, in the mean.
PART_ROWS = 250_000
#: Projections whose large table is dealt by a key before it is joined or grouped.
_DEALT = {"player_ratings": ("lineitem", "l_orderkey"), "rated_matches": ("lineitem", "l_orderkey"), "player_valuations": ("orders", "o_custkey")}


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Parts in which matches are dealt, so that what a task sorts and groups does not grow with the tables; the rows are counted from the file's footers.

    0 if adaptive execution makes as many by itself, one for each core.
    """
    n = -(-table(spark, sf_dir, "lineitem").count() // PART_ROWS)
    return n if n > spark.sparkContext.defaultParallelism else 0


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` in ``n`` parts by ``keys``, which adaptive execution leaves as they are; as it is if ``n`` is 0."""
    return df.repartition(n, *keys) if n else df


def projected(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A projection over the tables in ``sf_dir``."""
    n = parts(spark, sf_dir) if name in _DEALT else 0
    return on_tables(spark, sf_dir, f"WITH {ctes(name)} SELECT * FROM {name}", (*_DEALT[name], n) if n else None)


def on_tables(spark: SparkSession, sf_dir: str, sql: str, deal: tuple[str, str, int] | None = None) -> DataFrame:
    """Runs SQL whose base tables are the files in ``sf_dir``; ``deal`` names a table that is dealt by a column into parts."""

    def bound(m: re.Match) -> str:
        file = f"parquet.`{sf_dir}/{m[2]}.parquet`"
        if deal and deal[0] == m[2]:
            file = f"(SELECT /*+ REPARTITION({deal[2]}, {deal[1]}) */ * FROM {file})"
        return f"{m[1]} {file} AS {m[2]}"

    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(BASE)})\b", bound, sql))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
