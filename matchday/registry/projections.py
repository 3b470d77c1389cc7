"""Projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.config import (
    GAME_FEATURES,
    HOME,
    NON_FEATURES,
    SCHEDULE_COLUMNS,
    SEASON_TYPE_OF_GAME_TYPE,
    SIDE_FEATURES,
    TEAM_KEYS,
    TRAINING_FEATURES,
    WEEKLY_MEASURES,
    both_sides,
)
from matchday.functions import projections as P
from matchday.functions import scalars as S
from matchday.functions.calendar import week_of_season
from matchday.functions.predicates import target_rows
from matchday.functions.projections import q
from matchday.operators import aggregate as A
from matchday.plans import tables as T
from matchday.plans.training import split_features
from matchday.registry import Inputs, query
from matchday.registry.oracle import (
    CURRENT,
    KICKING_JOIN,
    SIDE_JOIN,
    TARGET,
    columns,
    recoded,
    table,
    with_tables,
)

RAW = "stg_schedules"
LINES = "stg_weekly_scores"


@query("int_schedules", table("int_schedules"))
def int_schedules(i: Inputs) -> DataFrame:
    return i.games


_REGULAR = """
SELECT game_id, game_type, CASE WHEN game_type = 'REG' THEN 'reg' ELSE 'post' END AS game_type_group,
       CASE WHEN game_type = 'REG' THEN 0 ELSE 1 END AS game_type_num
FROM stg_schedules
"""


@query("prj_type_flag", table("int_schedules", ["game_id", "game_type", "game_type_group", "game_type_num"]))
def prj_type_flag(i: Inputs) -> DataFrame:
    return i.games.select("game_id", "game_type", "game_type_group", "game_type_num")


@query("prj_type_flag_regular", with_tables(_REGULAR, RAW))
def prj_type_flag_regular(i: Inputs) -> DataFrame:
    games = T.clean_schedule(i.feed_games, regular_code="REG")
    return games.select("game_id", "game_type", "game_type_group", "game_type_num")


@query("prj_columns", table(LINES, [*TEAM_KEYS, *WEEKLY_MEASURES]))
def prj_columns(i: Inputs) -> DataFrame:
    return i.feed_weekly.select(*TEAM_KEYS, *WEEKLY_MEASURES)


_FILLED = f"""
SELECT game_id, coalesce(home_team, '0') AS home_team, coalesce(away_team, '0') AS away_team,
       coalesce(home_score, 0) AS home_score, coalesce(away_score, 0) AS away_score,
       coalesce(home_moneyline, 0) AS home_moneyline
FROM {RAW}
"""


@query("prj_fill_zero", with_tables(_FILLED, RAW))
def prj_fill_zero(i: Inputs) -> DataFrame:
    names = ["game_id", "home_team", "away_team", "home_score", "away_score", "home_moneyline"]
    return P.fill_zero(i.feed_games.select(*names))


@query(
    "prj_recode_map",
    with_tables(f"SELECT game_id, {recoded('game_type', SEASON_TYPE_OF_GAME_TYPE)} AS season_type FROM {RAW}", RAW),
)
def prj_recode_map(i: Inputs) -> DataFrame:
    return i.feed_games.select("game_id", S.season_type(q("game_type")).alias("season_type"))


@query(
    "prj_recode_else",
    with_tables(
        f"SELECT game_id, CASE WHEN game_type = 'REG' THEN 'REG' ELSE 'POST' END AS season_type FROM {RAW}", RAW
    ),
)
def prj_recode_else(i: Inputs) -> DataFrame:
    return i.feed_games.select("game_id", S.season_type_else_post(q("game_type")).alias("season_type"))


@query("prj_team_norm", table("int_schedules", ["game_id", "home_team", "away_team"]))
def prj_team_norm(i: Inputs) -> DataFrame:
    return i.games.select("game_id", "home_team", "away_team")


@query("prj_outcome", table("int_schedules", ["game_id", "home_score", "away_score", "outcome"]))
def prj_outcome(i: Inputs) -> DataFrame:
    return i.games.select("game_id", "home_score", "away_score", "outcome")


@query("prj_winner", table("int_schedules", ["game_id", "home_team", "away_team", "winner"]))
def prj_winner(i: Inputs) -> DataFrame:
    return i.games.select("game_id", "home_team", "away_team", "winner")


_TOTALS = f"""
SELECT game_id, home_score + away_score AS game_total_points, home_score - away_score AS score_diff FROM {RAW}
"""


@query("prj_total_diff", with_tables(_TOTALS, RAW))
def prj_total_diff(i: Inputs) -> DataFrame:
    return P.with_game_totals(i.feed_games).select("game_id", "game_total_points", "score_diff")


@query("prj_win_loss", table("team_stats", ["recent_team", "season", "week", "season_type", "result"]))
def prj_win_loss(i: Inputs) -> DataFrame:
    return i.team_results.select("recent_team", "season", "week", "season_type", "result")


@query("prj_derived", table("weekly_scores"))
def prj_derived(i: Inputs) -> DataFrame:
    return i.weekly_scores


_DROPPED = ["passing_2pt_conversions", "rushing_2pt_conversions", "touchdowns", "2pt_conversions"]


@query(
    "prj_derived_short",
    table(
        "weekly_scores",
        [*TEAM_KEYS, *[m for m in WEEKLY_MEASURES if m not in _DROPPED], "total_score", "total_yards_offense", "turnovers_offense"],
    ),
)
def prj_derived_short(i: Inputs) -> DataFrame:
    return P.with_derived_measures(A.team_week_filled(i.feed_weekly), keep_parts=False)


@query("prj_td_points", table("int_team_stats", [*TEAM_KEYS, "touchdown_points", "touchdowns_scored"]))
def prj_td_points(i: Inputs) -> DataFrame:
    return i.team_stats.select(*TEAM_KEYS, "touchdown_points", "touchdowns_scored")


_KICKING = ["season", "week", "home_team", "away_team", "home_kicking_points", "away_kicking_points"]


@query("prj_kicking_points", table("score_data", _KICKING))
def prj_kicking_points(i: Inputs) -> DataFrame:
    return A.score_data(i.games, i.team_stats).select(*_KICKING)


_RATIOS = """
SELECT recent_team, season, week, season_type, rushing_yards / nullif(carries, 0) AS yards_per_carry,
       rushing_tds / nullif(carries, 0) AS rush_td_efficiency
FROM int_team_stats
"""


@query("prj_ratio", with_tables(_RATIOS, "int_team_stats"))
def prj_ratio(i: Inputs) -> DataFrame:
    return i.team_stats.select(
        "recent_team",
        "season",
        "week",
        "season_type",
        S.ratio(q("rushing_yards"), q("carries")).alias("yards_per_carry"),
        S.ratio(q("rushing_tds"), q("carries")).alias("rush_td_efficiency"),
    )


_ENCODED = """
SELECT season, week, home_score, CASE season_type WHEN 'REG' THEN 0 WHEN 'POST' THEN 1 END AS season_type, outcome
FROM schedules
"""


@query("prj_label_encode", with_tables(_ENCODED, "schedules"))
def prj_label_encode(i: Inputs) -> DataFrame:
    rows = i.schedule.select("game_id", "season", "week", "home_score", "season_type", "outcome")
    return split_features(rows)


_STRIPPED = f"""
SELECT home_team AS team, count(*) AS games, sum(home_score) AS score, avg(home_rest) AS rest
FROM {RAW} WHERE home_team IS NOT NULL GROUP BY home_team
"""


@query("prj_rename_strip", with_tables(_STRIPPED, RAW))
def prj_rename_strip(i: Inputs) -> DataFrame:
    rows = i.feed_games.where("home_team IS NOT NULL").groupBy("home_team").agg(
        F.count(F.lit(1)).alias("games"),
        F.sum("home_score").alias("score" + HOME),
        F.avg("home_rest").alias("rest" + HOME),
    )
    return P.strip_suffix(rows, "home_team", HOME)


@query(
    "prj_suffix",
    with_tables(f"SELECT {columns(TEAM_KEYS)}, {columns(SIDE_FEATURES, suffix='_home')} FROM int_team_stats", "int_team_stats"),
)
def prj_suffix(i: Inputs) -> DataFrame:
    return i.team_stats.select(*TEAM_KEYS, *P.suffixed(SIDE_FEATURES, HOME))


@query("prj_drop", table("schedules", [c for c in SCHEDULE_COLUMNS if c not in NON_FEATURES]))
def prj_drop(i: Inputs) -> DataFrame:
    return P.drop_columns(i.schedule, NON_FEATURES)


_EXPECTED = ["game_id", "season", "home_moneyline", "passing_yards_home", "passing_yards_away"]


@query(
    "prj_reindex",
    with_tables(
        f"SELECT game_id, season, home_moneyline, 0 AS passing_yards_home, 0 AS passing_yards_away FROM {RAW}", RAW
    ),
)
def prj_reindex(i: Inputs) -> DataFrame:
    return P.reindex(i.feed_games, _EXPECTED)


_FIRST = ["game_id", "home_team", "season"]


@query("prj_dedup_columns", table(RAW, _FIRST))
def prj_dedup_columns(i: Inputs) -> DataFrame:
    doubled = i.feed_games.select("game_id", "home_team", "season", q("away_team").alias("home_team"), "season")
    return P.first_of_each_name(doubled)


_MASKED = f"""
SELECT game_id, CAST(0 AS DOUBLE) AS home_score, CAST(0 AS DOUBLE) AS away_score
FROM {RAW} WHERE season = {CURRENT} AND week = {TARGET}
"""


@query("prj_mask_label", with_tables(_MASKED, RAW))
def prj_mask_label(i: Inputs) -> DataFrame:
    rows = i.feed_games.where(target_rows(i.cfg)).select("game_id", "home_score", "away_score")
    return P.mask_label(rows)


@query(
    "prj_literal",
    with_tables(f"SELECT game_id, home_team, away_team, {TARGET} AS prediction_week FROM int_schedules", "int_schedules"),
)
def prj_literal(i: Inputs) -> DataFrame:
    return i.games.select("game_id", "home_team", "away_team", F.lit(TARGET).alias("prediction_week"))


TRAINING_SQL = with_tables(
    f"""
    SELECT s.home_team, s.away_team, s.outcome, {columns(GAME_FEATURES, "s")},
           {columns(SIDE_FEATURES, "hs", "_home")}, {columns(SIDE_FEATURES, "aw", "_away")}
    FROM int_schedules AS s {SIDE_JOIN} {KICKING_JOIN}""",
    "int_schedules",
    "int_team_stats",
    "kicking_stats",
)
FEATURES_SQL = with_tables(
    f"""
    SELECT {columns(GAME_FEATURES, "s")}, {columns(SIDE_FEATURES, "hs", "_home")}, {columns(SIDE_FEATURES, "aw", "_away")}
    FROM int_schedules AS s {SIDE_JOIN} {KICKING_JOIN}""",
    "int_schedules",
    "int_team_stats",
    "kicking_stats",
)


@query("prj_feature_row", FEATURES_SQL)
def prj_feature_row(i: Inputs) -> DataFrame:
    return i.training_data.select(*TRAINING_FEATURES)


_WEEKS = """
SELECT o_orderkey, CAST(greatest(1, ceil((CAST(o_orderdate AS DATE) - DATE '2000-01-01') / 7.0)) AS INTEGER) AS season_week
FROM orders
"""


@query("fn_week_of_season", _WEEKS)
def fn_week_of_season(i: Inputs) -> DataFrame:
    orders = i.spark.read.parquet(f"{i.folder}/orders.parquet")
    week = week_of_season(q("o_orderdate").cast("date"), i.cfg.season_start)
    return orders.select("o_orderkey", week.alias("season_week"))


_HELD = [c for c in GAME_FEATURES]
_LACKING = sorted(both_sides(SIDE_FEATURES))
_DIFF = with_tables(
    "\nUNION ALL\n".join(
        [
            f"SELECT '{c}' AS column_name, true AS available, true AS expected, false AS missing, count({c}) AS filled_rows FROM int_schedules"
            for c in _HELD
        ]
        + [
            f"SELECT '{c}' AS column_name, false AS available, true AS expected, true AS missing, CAST(0 AS BIGINT) AS filled_rows"
            for c in _LACKING
        ]
        + ["SELECT 'game_id', true, false, false, count(game_id) FROM int_schedules"]
    ),
    "int_schedules",
)


@query("fn_schema_diff", _DIFF)
def fn_schema_diff(i: Inputs) -> DataFrame:
    return P.schema_diff(i.games.select("game_id", *GAME_FEATURES), TRAINING_FEATURES)
