"""Joins and the tables they form."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchday.config import (
    GAME_FEATURES,
    LAG_AVERAGES,
    LAG_TOTALS,
    PROFILE_SPEC,
    SCHEDULE_COLUMNS,
    SCORE_SIDE_MEASURES,
    SIDE_FEATURES,
    WEEKLY_MEASURES,
)
from matchday.functions.predicates import target_rows, training_rows
from matchday.operators import aggregate as A
from matchday.operators import joins as J
from matchday.plans import features as X
from matchday.plans import tables as T
from matchday.registry import Inputs, query
from matchday.registry.oracle import (
    CURRENT,
    CUTOFF,
    KICKING_JOIN,
    SIDE_JOIN,
    TARGET,
    columns,
    table,
    with_tables,
)
from matchday.registry.projections import TRAINING_SQL
from matchday.registry.storage import INPUT_SQL, LINE, STORED, target_input_sql

PLACE = ["game_id", "season", "week", "home_team", "away_team"]

_TYPED = f"""
SELECT {columns([*PLACE, "game_type"], "s")}, hs.touchdown_points AS touchdown_points_home,
       aw.touchdown_points AS touchdown_points_away
FROM int_schedules AS s
LEFT JOIN int_team_stats AS hs ON hs.recent_team = s.home_team AND hs.week = s.week AND hs.season = s.season
     AND hs.season_type = s.game_type
LEFT JOIN int_team_stats AS aw ON aw.recent_team = s.away_team AND aw.week = s.week AND aw.season = s.season
     AND aw.season_type = s.game_type
"""


@query("join_sides_typed", with_tables(_TYPED, "int_schedules", "int_team_stats"))
def join_sides_typed(i: Inputs) -> DataFrame:
    games = i.games.select(*PLACE, "game_type")
    on = [("week", "week"), ("season", "season"), ("game_type", "season_type")]
    return J.join_sides(games, i.team_stats, ["touchdown_points"], on)


_SIDES = f"""
SELECT {columns(PLACE, "s")}, {columns(SIDE_FEATURES, "hs", "_home")}, {columns(SIDE_FEATURES, "aw", "_away")}
FROM int_schedules AS s {SIDE_JOIN}
"""


@query("join_sides", with_tables(_SIDES, "int_schedules", "int_team_stats"))
def join_sides(i: Inputs) -> DataFrame:
    return J.join_sides(i.games.select(*PLACE), i.team_stats, SIDE_FEATURES)


@query("join_sides_merge", table("base_model"))
def join_sides_merge(i: Inputs) -> DataFrame:
    return i.base_model


_KICKED = f"""
SELECT {columns(PLACE, "s")}, hk.kicking_points AS kicking_points_home, ak.kicking_points AS kicking_points_away
FROM int_schedules AS s {SIDE_JOIN} {KICKING_JOIN}
"""


@query("join_kicking", with_tables(_KICKED, "int_schedules", "int_team_stats", "kicking_stats"))
def join_kicking(i: Inputs) -> DataFrame:
    return T.weekly_score_rows(i.games, i.stored_team_stats, columns=["kicking_points"], keep=PLACE)


_SCORES = f"""
SELECT s.home_team, s.away_team, s.outcome, {columns(GAME_FEATURES, "s")},
       {columns(SCORE_SIDE_MEASURES, "hs", "_home")}, hk.kicking_points AS kicking_points_home,
       {columns(SCORE_SIDE_MEASURES, "aw", "_away")}, ak.kicking_points AS kicking_points_away
FROM int_schedules AS s {SIDE_JOIN} {KICKING_JOIN}
"""


@query("int_weekly_score", with_tables(_SCORES, "int_schedules", "int_team_stats", "kicking_stats"))
def int_weekly_score(i: Inputs) -> DataFrame:
    return T.weekly_score_rows(i.games, i.stored_team_stats)


@query("rf_training_data", TRAINING_SQL)
def rf_training_data(i: Inputs) -> DataFrame:
    return i.training_data


_WEIGHTED = f"""
SELECT s.game_id, s.home_team, s.away_team, s.outcome, {columns(GAME_FEATURES, "s")},
       {columns(SIDE_FEATURES, "hs", "_home")}, {columns(SIDE_FEATURES, "aw", "_away")}, count(*) AS weight
FROM int_schedules AS s {SIDE_JOIN} {KICKING_JOIN}
GROUP BY ALL
"""


@query("rf_training_data_weighted", with_tables(_WEIGHTED, "int_schedules", "int_team_stats", "kicking_stats"))
def rf_training_data_weighted(i: Inputs) -> DataFrame:
    return T.training_data(i.games, i.team_stats, weight="weight", keep=["game_id"])


@query("join_result", table("team_stats"))
def join_result(i: Inputs) -> DataFrame:
    return i.team_results


def _statistic(how: str, column: str) -> str:
    return {
        "mean": f"avg({column})",
        "median": f"median({column})",
        "sum": f"coalesce(sum({column}), 0)",
    }[how]


def profile_sql(side: str) -> str:
    parts = ", ".join(f"{_statistic(how, f'{c}_{side}')} AS {c}" for c, how in PROFILE_SPEC.items())
    return (
        f"SELECT {side}_team AS team, {parts} FROM history"
        f" WHERE week <= {CUTOFF} AND {side}_team IS NOT NULL GROUP BY {side}_team"
    )


_PROFILED = f"""
SELECT {columns([c for c in SCHEDULE_COLUMNS if c not in ("home_score", "away_score")], "s")}, s.outcome, s.game_total_points,
       CAST(0 AS DOUBLE) AS home_score, CAST(0 AS DOUBLE) AS away_score,
       {columns(PROFILE_SPEC, "hp", "_home")}, {columns(PROFILE_SPEC, "ap", "_away")}
FROM schedules AS s
LEFT JOIN ({profile_sql("home")}) AS hp ON hp.team = s.home_team
LEFT JOIN ({profile_sql("away")}) AS ap ON ap.team = s.away_team
WHERE s.season = {CURRENT} AND s.week = {TARGET}
"""


@query("join_profile", with_tables(_PROFILED, "schedules", "history"))
def join_profile(i: Inputs) -> DataFrame:
    return X.profile_features(i.schedule, i.profile_history, i.cfg)


_SINGLE = f"""
SELECT {columns(PLACE, "s")}, {columns(WEEKLY_MEASURES, "hp")}, {columns(WEEKLY_MEASURES, "ap", "_away")},
       ap.recent_team AS recent_team_away
FROM schedules AS s
LEFT JOIN mean_profile AS hp ON hp.recent_team = s.home_team
LEFT JOIN mean_profile AS ap ON ap.recent_team = s.away_team
WHERE s.season = {CURRENT} AND s.week = {TARGET}
"""
MEAN_PROFILE = (
    f"SELECT recent_team, {', '.join(f'avg({m}) AS {m}' for m in WEEKLY_MEASURES)} FROM weekly_scores"
    f" WHERE (season < {CURRENT} OR (season = {CURRENT} AND week <= {CUTOFF})) GROUP BY recent_team"
)


@query(
    "join_profile_single",
    with_tables(
        _SINGLE.replace("mean_profile", f"({MEAN_PROFILE})"), "schedules", "weekly_scores"
    ),
)
def join_profile_single(i: Inputs) -> DataFrame:
    profile = A.mean_profile(i.weekly_scores.where(training_rows(i.cfg)))
    games = i.schedule.where(target_rows(i.cfg)).select(*PLACE)
    return J.join_single_profile(games, profile, WEEKLY_MEASURES)


@query("join_lag_features", INPUT_SQL)
def join_lag_features(i: Inputs) -> DataFrame:
    return X.lag_feature_rows(i.games, i.team_stats, i.cfg)


@query("rf_prediction_inputs", target_input_sql(TARGET))
def rf_prediction_inputs(i: Inputs) -> DataFrame:
    return X.target_week_inputs(i.games, i.team_stats, i.cfg)


_LAG_MEASURES = [*LAG_AVERAGES, *LAG_TOTALS]
_LAG_KICKED = f"""
SELECT {columns(PLACE, "s")}, {columns(_LAG_MEASURES, "hs", "_home")}, {columns(_LAG_MEASURES, "aw", "_away")},
       hk.avg_kicking_points AS avg_kicking_points_home, ak.avg_kicking_points AS avg_kicking_points_away
FROM int_schedules AS s
LEFT JOIN lag_profile AS hs ON hs.recent_team = s.home_team AND hs.season = s.season AND hs.week = s.week
LEFT JOIN lag_profile AS aw ON aw.recent_team = s.away_team AND aw.season = s.season AND aw.week = s.week
LEFT JOIN kicking_avg AS hk ON hk.team = s.home_team AND hk.season = s.season AND hk.week = s.week
LEFT JOIN kicking_avg AS ak ON ak.team = s.away_team AND ak.season = s.season AND ak.week = s.week
"""


@query("join_lag_features_kicking", with_tables(_LAG_KICKED, "int_schedules", "lag_profile", "kicking_avg"))
def join_lag_features_kicking(i: Inputs) -> DataFrame:
    return X.lag_feature_rows_with_kicking(i.games, i.stored_team_stats, i.cfg)


@query("join_anti_new", table("stg_weekly_scores", LINE, f"NOT {STORED}"))
def join_anti_new(i: Inputs) -> DataFrame:
    rows = i.feed_weekly.select(*LINE)
    return J.unseen_periods(rows, rows.where(STORED))


@query("agg_profile_sides", with_tables(
    f"SELECT 'home' AS side, * FROM ({profile_sql('home')}) AS h UNION ALL SELECT 'away' AS side, * FROM ({profile_sql('away')}) AS a",
    "history",
))
def agg_profile_sides(i: Inputs) -> DataFrame:
    return A.side_profiles(i.profile_history, PROFILE_SPEC)


@query("agg_profile_mean", with_tables(MEAN_PROFILE, "weekly_scores"))
def agg_profile_mean(i: Inputs) -> DataFrame:
    return A.mean_profile(i.weekly_scores.where(training_rows(i.cfg)))
