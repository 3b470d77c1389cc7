"""The prediction inputs of one target week as a parameterised query text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchday.config import GAME_FEATURES, LAG_AVERAGES, LAG_FEATURE_SOURCE, LAG_TOTALS, SIDE_FEATURES, SeasonConfig
from matchday.functions.calendar import lag_periods


def _profile_measures() -> str:
    used = set(LAG_FEATURE_SOURCE.values())
    averages = [f"avg({src}) AS {out}" for out, src in LAG_AVERAGES.items() if out in used]
    totals = [f"sum({m}) AS {m}" for m in LAG_TOTALS if m in used]
    return ", ".join(averages + totals)


def _side_features(alias: str, suffix: str) -> str:
    return ", ".join(f"{alias}.{LAG_FEATURE_SOURCE[m]} AS {m}_{suffix}" for m in SIDE_FEATURES)


PREDICTION_INPUT_SQL = f"""
WITH window_rows AS (
  SELECT t.* FROM {{team_stats}} AS t
  JOIN (SELECT inline(transform(:periods, p -> named_struct('season', p[0], 'week', p[1])))) AS w
    ON t.season = w.season AND t.week = w.week
), profile AS (
  SELECT recent_team, {_profile_measures()} FROM window_rows GROUP BY recent_team
)
SELECT g.game_id, g.home_team, g.away_team, {", ".join("g." + c for c in GAME_FEATURES)},
       {_side_features("h", "home")},
       {_side_features("a", "away")}
FROM {{games}} AS g
LEFT JOIN profile AS h ON h.recent_team = g.home_team
LEFT JOIN profile AS a ON a.recent_team = g.away_team
WHERE g.season = :season AND g.week = :week
"""


def target_week_query(spark: SparkSession, games: DataFrame, team_stats: DataFrame, cfg: SeasonConfig) -> DataFrame:
    """Fill the query text with the season, the target week and its window."""
    periods = lag_periods(cfg.current_season, cfg.target_week, cfg.lag, cfg.last_regular_week)
    values = {
        "season": cfg.current_season,
        "week": cfg.target_week,
        "periods": [list(p) for p in periods],
    }
    return spark.sql(PREDICTION_INPUT_SQL, args=values, games=games, team_stats=team_stats)
