"""SQL building blocks of the reference results: one common table expression per table."""

from __future__ import annotations

from matchday.config import (
    DERIVED_MEASURES,
    LAG_AVERAGES,
    LAG_FEATURE_SOURCE,
    LAG_TOTALS,
    MEASURES,
    SCHEDULE_COLUMNS,
    SCHEDULE_PASS_THROUGH,
    SEASON_TYPE_OF_GAME_TYPE,
    WEEKLY_MEASURES,
    SeasonConfig,
)
from matchday.functions.calendar import lag_periods, week_number
from matchday.sources.star_schema import SCHEDULES_SQL, WEEKLY_SQL

CFG = SeasonConfig()
CURRENT, TARGET, CUTOFF = CFG.current_season, CFG.target_week, CFG.cutoff_week
THIS_WEEK = week_number(CFG.as_of, CFG.season_start)
TRAINING_ROWS = f"(season < {CURRENT} OR (season = {CURRENT} AND week <= {CUTOFF}))"


def ident(name: str) -> str:
    return f'"{name}"'


def columns(names, alias: str = "", suffix: str = "") -> str:
    prefix = f"{alias}." if alias else ""
    return ", ".join(f"{prefix}{ident(n)} AS {ident(n + suffix)}" for n in names)


def sums(names) -> str:
    return ", ".join(f"sum({ident(n)}) AS {ident(n)}" for n in names)


def recoded(column: str, mapping) -> str:
    whens = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} END"


def lag_predicate(season: int, week: int) -> str:
    return "(" + " OR ".join(f"(season = {s} AND week = {w})" for s, w in lag_periods(season, week)) + ")"


_TD = "sum(rushing_tds) + sum(receiving_tds) + sum(special_teams_tds)"

_SIDE_JOIN = """
LEFT JOIN {stats} AS hs ON s.home_team = hs.recent_team AND s.season = hs.season AND s.week = hs.week
LEFT JOIN {stats} AS aw ON s.away_team = aw.recent_team AND s.season = aw.season AND s.week = aw.week
"""
SIDE_JOIN = _SIDE_JOIN.format(stats="int_team_stats")
KICKING_JOIN = """
LEFT JOIN kicking_stats AS hk ON hs.recent_team = hk.team AND s.season = hk.season AND s.week = hk.week
LEFT JOIN kicking_stats AS ak ON aw.recent_team = ak.team AND s.season = ak.season AND s.week = ak.week
"""

_LAG_AGGREGATES = ", ".join(
    [f"avg(t.{src}) AS {out}" for out, src in LAG_AVERAGES.items()] + [f"sum(t.{m}) AS {m}" for m in LAG_TOTALS]
)

_FILLED = ", ".join(f"coalesce({m}, 0) AS {m}" for m in WEEKLY_MEASURES)

# name -> (tables it reads, text)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "stg_schedules": ((), SCHEDULES_SQL.format(orders="orders", all_orders="orders")),
    "stg_weekly_scores": ((), WEEKLY_SQL.format(orders="orders", all_orders="orders", lineitem="lineitem")),
    "int_schedules": (
        ("stg_schedules",),
        f"""
        SELECT game_id, season, game_type,
               CASE WHEN game_type = 'reg' THEN 'reg' ELSE 'post' END AS game_type_group,
               CASE WHEN game_type = 'reg' THEN 0 ELSE 1 END AS game_type_num,
               week, gameday, weekday, gametime,
               CASE WHEN coalesce(away_team, 'OAK') = 'OAK' THEN 'LV' ELSE away_team END AS away_team, away_score,
               CASE WHEN coalesce(home_team, 'OAK') = 'OAK' THEN 'LV' ELSE home_team END AS home_team, home_score,
               CASE WHEN home_score > away_score THEN 1 ELSE 0 END AS outcome,
               CASE WHEN f.home_score > f.away_score THEN f.home_team ELSE f.away_team END AS winner,
               {", ".join(SCHEDULE_PASS_THROUGH)}
        FROM stg_schedules AS f""",
    ),
    "int_team_stats": (
        ("stg_weekly_scores",),
        f"""
        SELECT recent_team, season, season_type, week, ({_TD}) * 6 AS touchdown_points,
               {_TD} AS touchdowns_scored, {sums(MEASURES)}
        FROM stg_weekly_scores GROUP BY recent_team, season, season_type, week""",
    ),
    "score_data": (
        ("int_schedules", "int_team_stats"),
        """
        SELECT season, week, home_team, away_team, home_score, away_score,
               home_touchdown_points, away_touchdown_points,
               home_score - home_touchdown_points AS home_kicking_points,
               away_score - away_touchdown_points AS away_kicking_points
        FROM (SELECT s.season, s.week, s.home_team, s.away_team,
                     sum(s.home_score) AS home_score, sum(s.away_score) AS away_score,
                     coalesce(sum(hs.touchdown_points), 0) AS home_touchdown_points,
                     coalesce(sum(aw.touchdown_points), 0) AS away_touchdown_points
              FROM int_schedules AS s
              LEFT JOIN int_team_stats AS hs ON hs.recent_team = s.home_team AND hs.week = s.week
                   AND hs.season = s.season AND hs.season_type = s.game_type
              LEFT JOIN int_team_stats AS aw ON aw.recent_team = s.away_team AND aw.week = s.week
                   AND aw.season = s.season AND aw.season_type = s.game_type
              GROUP BY s.season, s.week, s.home_team, s.away_team) AS pairing""",
    ),
    "kicking_stats": (
        ("score_data",),
        """
        SELECT season, week, home_team AS team, home_kicking_points AS kicking_points FROM score_data
        UNION ALL
        SELECT season, week, away_team, away_kicking_points FROM score_data""",
    ),
    "sides": (
        ("int_schedules",),
        """
        SELECT game_id, season, week, home_team AS recent_team, winner FROM int_schedules
        UNION ALL
        SELECT game_id, season, week, away_team, winner FROM int_schedules""",
    ),
    "team_stats": (
        ("int_team_stats", "sides"),
        f"""
        SELECT t.recent_team, CASE WHEN s.winner = t.recent_team THEN 'win' ELSE 'loss' END AS result,
               t.season, t.season_type, t.week, t.touchdown_points, t.touchdowns_scored,
               {columns(MEASURES, "t")}
        FROM int_team_stats AS t JOIN sides AS s
          ON s.recent_team = t.recent_team AND s.season = t.season AND s.week = t.week""",
    ),
    "rushing": (
        ("team_stats",),
        """
        SELECT result, carries, rushing_yards, rushing_tds,
               rushing_yards / nullif(carries, 0) AS yards_per_carry,
               rushing_tds / nullif(carries, 0) AS rush_td_efficiency
        FROM team_stats""",
    ),
    "weekly_sums": (
        ("stg_weekly_scores",),
        f"""
        SELECT recent_team, season, season_type, week, {sums(WEEKLY_MEASURES)}
        FROM (SELECT coalesce(recent_team, '0') AS recent_team, coalesce(season, 0) AS season,
                     coalesce(season_type, '0') AS season_type, coalesce(week, 0) AS week, {_FILLED}
              FROM stg_weekly_scores) AS filled
        GROUP BY recent_team, season, season_type, week""",
    ),
    "weekly_scores": (
        ("weekly_sums",),
        """
        SELECT *, touchdowns + "2pt_conversions" AS total_score
        FROM (SELECT *, 6 * (passing_tds + rushing_tds + special_teams_tds) AS touchdowns,
                     2 * (passing_2pt_conversions + rushing_2pt_conversions) AS "2pt_conversions",
                     passing_yards + rushing_yards AS total_yards_offense,
                     interceptions + rushing_fumbles AS turnovers_offense
              FROM weekly_sums) AS parts""",
    ),
    "schedules": (
        ("stg_schedules",),
        f"""
        SELECT {", ".join(SCHEDULE_COLUMNS)},
               CASE WHEN home_score > away_score THEN 1 ELSE 0 END AS outcome,
               home_score + away_score AS game_total_points
        FROM (SELECT *, {recoded("game_type", SEASON_TYPE_OF_GAME_TYPE)} AS season_type FROM stg_schedules) AS typed
        WHERE season <= {CURRENT} AND week <= {THIS_WEEK}""",
    ),
    "base_model": (
        ("schedules", "weekly_scores"),
        f"""
        SELECT s.*, s.home_score - s.away_score AS score_diff,
               {columns([*WEEKLY_MEASURES, *DERIVED_MEASURES], "hs", "_home")},
               {columns([*WEEKLY_MEASURES, *DERIVED_MEASURES], "aw", "_away")}
        FROM schedules AS s
        LEFT JOIN weekly_scores AS hs ON s.home_team IS NOT DISTINCT FROM hs.recent_team AND s.season = hs.season
             AND s.week = hs.week AND s.season_type IS NOT DISTINCT FROM hs.season_type
        LEFT JOIN weekly_scores AS aw ON s.away_team IS NOT DISTINCT FROM aw.recent_team AND s.season = aw.season
             AND s.week = aw.week AND s.season_type IS NOT DISTINCT FROM aw.season_type""",
    ),
    "history": (("base_model",), f"SELECT * FROM base_model WHERE {TRAINING_ROWS}"),
    "targets": (
        ("stg_schedules",),
        """
        SELECT s.season, w.week FROM (SELECT DISTINCT season FROM stg_schedules
                                      UNION SELECT season + 1 FROM stg_schedules) AS s
        CROSS JOIN (SELECT CAST(unnest(range(1, 23)) AS INTEGER) AS week) AS w""",
    ),
    "lag_window": (
        ("targets",),
        """
        SELECT season AS target_season, week AS target_week,
               CAST(CASE WHEN week - back >= 1 THEN season ELSE season - 1 END AS INTEGER) AS season,
               CAST(CASE WHEN week - back >= 1 THEN week - back ELSE 18 + week - back END AS INTEGER) AS week
        FROM targets CROSS JOIN (VALUES (1), (2), (3)) AS lags(back)""",
    ),
    "lag_profile": (
        ("int_team_stats", "lag_window"),
        f"""
        SELECT c.target_season AS season, c.target_week AS week, t.recent_team, {_LAG_AGGREGATES}
        FROM int_team_stats AS t JOIN lag_window AS c ON t.season = c.season AND t.week = c.week
        GROUP BY c.target_season, c.target_week, t.recent_team""",
    ),
    "kicking_avg": (
        ("kicking_stats", "lag_window"),
        """
        SELECT c.target_season AS season, c.target_week AS week, k.team, avg(k.kicking_points) AS avg_kicking_points
        FROM kicking_stats AS k JOIN lag_window AS c ON k.season = c.season AND k.week = c.week
        GROUP BY c.target_season, c.target_week, k.team""",
    ),
    "lag_features": (
        ("lag_profile",),
        "SELECT recent_team, season, week, "
        + ", ".join(f"{src} AS {name}" for name, src in LAG_FEATURE_SOURCE.items())
        + " FROM lag_profile",
    ),
    "baseline": (
        ("int_schedules",),
        """
        SELECT game_id, season, week, outcome, CASE WHEN spread_line > 0 THEN 1 ELSE 0 END AS predicted
        FROM int_schedules""",
    ),
}


def with_tables(body: str, *needs: str) -> str:
    """``body`` after the definitions of ``needs`` and everything they read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in TABLES[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in ordered)
    return f"WITH {parts}\n{body}"


def table(name: str, names=None, where: str | None = None) -> str:
    """Whole table, or some of its columns and rows."""
    picked = columns(names) if names else "*"
    return with_tables(f"SELECT {picked} FROM {name}" + (f" WHERE {where}" if where else ""), name)
