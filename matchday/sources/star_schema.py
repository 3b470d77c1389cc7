"""View of an order / line-item star schema as matchup feeds.

Orders become games, line items become member statistics. The mapping is integer arithmetic in SQL
that any engine evaluates alike; ``{orders}`` and ``{lineitem}`` stand for the two tables, and
``{all_orders}`` for the scan that is only counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchday.config import MEASURES
from matchday.operators.skew import DEFAULT_POLICY, SkewPolicy, salted_join

PERIODS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
       o_custkey % t AS h,
       (o_custkey % t + 1 + o_orderkey % (t - 1)) % t AS a,
       CAST(year(o_orderdate) AS INT) AS season,
       CAST(floor((dayofyear(o_orderdate) - 1) / 17) AS INT) + 1 AS week
FROM (SELECT *, (SELECT greatest(8, CAST(floor(count(*) / 75) AS BIGINT)) FROM {all_orders}) AS t
      FROM {orders}) AS sized
"""


def _team(index: str) -> str:
    return f"CASE WHEN {index} = 0 THEN 'OAK' WHEN {index} >= 2 THEN concat('T', CAST({index} AS STRING)) END"


def _odds(expression: str, missing_every: int) -> str:
    return f"CASE WHEN o_orderkey % {missing_every} <> 0 THEN CAST({expression} AS DOUBLE) END"


_HOME_SCORE = "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey * 7 % 45 AS DOUBLE) END"
_AWAY_SCORE = "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey * 11 % 45 AS DOUBLE) END"

SCHEDULES_SQL = f"""
SELECT CAST(o_orderkey AS STRING) AS game_id, season, week,
       CASE WHEN week <= 18 THEN 'REG' WHEN week = 19 THEN 'WC' WHEN week = 20 THEN 'DIV'
            WHEN week = 21 THEN 'CON' ELSE 'SB' END AS game_type,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS gameday,
       concat('day', CAST(o_orderkey % 7 AS STRING)) AS weekday,
       concat(CAST(12 + o_orderkey % 9 AS STRING), ':00') AS gametime,
       {_team("h")} AS home_team,
       {_team("a")} AS away_team,
       {_HOME_SCORE} AS home_score,
       {_AWAY_SCORE} AS away_score,
       CASE WHEN o_orderkey % 40 = 0 THEN 'Neutral' ELSE 'Home' END AS location,
       {_HOME_SCORE} + {_AWAY_SCORE} AS total,
       CAST(CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS INT) AS overtime,
       CAST(4 + o_orderkey % 11 AS INT) AS home_rest,
       CAST(4 + o_custkey % 11 AS INT) AS away_rest,
       {_odds("o_custkey % 400 - 200", 23)} AS home_moneyline,
       {_odds("o_orderkey % 400 - 200", 23)} AS away_moneyline,
       CAST(o_custkey % 29 - 14 AS DOUBLE) / 2 AS spread_line,
       {_odds("-(100 + o_orderkey % 25)", 31)} AS home_spread_odds,
       {_odds("-(100 + o_custkey % 25)", 31)} AS away_spread_odds,
       CAST(35 + o_custkey % 40 AS DOUBLE) / 2 + 20 AS total_line,
       {_odds("-(100 + o_orderkey % 19)", 37)} AS under_odds,
       {_odds("-(100 + o_custkey % 19)", 37)} AS over_odds,
       CAST(CASE WHEN h % 4 = a % 4 THEN 1 ELSE 0 END AS INT) AS div_game,
       CASE WHEN h % 3 = 0 THEN 'dome' ELSE 'outdoors' END AS roof,
       CASE WHEN h % 5 < 3 THEN 'grass' ELSE 'turf' END AS surface,
       CASE WHEN h % 3 <> 0 THEN CAST(20 + o_orderkey % 70 AS DOUBLE) END AS temp,
       CASE WHEN h % 3 <> 0 THEN CAST(o_orderkey % 30 AS DOUBLE) END AS wind,
       concat('p', CAST(a AS STRING)) AS away_qb_id,
       concat('p', CAST(h AS STRING)) AS home_qb_id,
       concat('Player ', CAST(a AS STRING)) AS away_qb_name,
       concat('Player ', CAST(h AS STRING)) AS home_qb_name,
       concat('Coach ', CAST(a % 50 AS STRING)) AS away_coach,
       concat('Coach ', CAST(h % 50 AS STRING)) AS home_coach,
       concat('Referee ', CAST(o_orderkey % 17 AS STRING)) AS referee,
       concat('s', CAST(h AS STRING)) AS stadium_id,
       concat('Stadium ', CAST(h AS STRING)) AS stadium
FROM ({PERIODS_SQL}) AS periods
"""


def _modulus(measure: str) -> int:
    if "yards" in measure:
        return 97
    small = ("tds", "2pt", "fumbles", "interceptions", "sacks")
    return 3 if any(part in measure for part in small) else 13


def _measure(position: int, name: str) -> str:
    """Varies with quantity, line and part; NULL for one order key in eleven."""
    empty = -position % 11
    value = f"(base + step * {position}) % {_modulus(name)}"
    return f"CASE WHEN order_class <> {empty} THEN CAST({value} AS DOUBLE) END AS {name}"


_MEASURES_SQL = ",\n       ".join(_measure(i, name) for i, name in enumerate(MEASURES))

# The shared parts of all measures are computed once per line: 31 copies of the whole arithmetic
# would make a generated method too large for the JVM to compile.
LINES_SQL = """
SELECT l_orderkey,
       CAST(l_orderkey % 11 AS INT) AS order_class,
       CAST(l_quantity AS BIGINT) * 3 + l_linenumber * 7 + l_partkey AS base,
       CAST(l_quantity AS BIGINT) + l_partkey AS step
FROM {lineitem}
"""

STATISTICS_SQL = f"""
SELECT CASE WHEN h <= 1 THEN 'LV' ELSE concat('T', CAST(h AS STRING)) END AS recent_team,
       season, week,
       CASE WHEN week <= 18 THEN 'REG' ELSE 'POST' END AS season_type,
       {_MEASURES_SQL}
FROM {{lines_in_period}}
"""

# The whole view as one text, for engines that join without help.
WEEKLY_SQL = STATISTICS_SQL.replace(
    "{lines_in_period}", f"({LINES_SQL}) AS line JOIN ({PERIODS_SQL}) AS periods ON l_orderkey = o_orderkey"
)


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan of one table, its rows dealt out evenly if it is a single file: that may be one row group, which Spark reads as one task."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df if len(df.inputFiles()) > 1 else df.hint("rebalance")


def schedules(spark: SparkSession, folder: str) -> DataFrame:
    all_orders = spark.read.parquet(f"{folder}/orders.parquet")
    orders = _read(spark, folder, "orders")
    return spark.sql(SCHEDULES_SQL, orders=orders, all_orders=all_orders)


def weekly_scores(spark: SparkSession, folder: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row per line item."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    periods = spark.sql(PERIODS_SQL, orders=orders, all_orders=orders)
    lines = spark.sql(LINES_SQL, lineitem=_read(spark, folder, "lineitem"))
    joined = salted_join(lines, periods, [("l_orderkey", "o_orderkey")], ["base", "step"], "inner", policy=policy)
    return spark.sql(STATISTICS_SQL, lines_in_period=joined)
