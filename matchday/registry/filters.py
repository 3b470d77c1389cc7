"""Row filters."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions import predicates as P
from matchday.functions.calendar import lag_calendar
from matchday.operators.joins import KEY, distinct_periods
from matchday.operators.lag import expanding_totals
from matchday.plans.backtest import period_sizes
from matchday.registry import Inputs, query
from matchday.registry.oracle import CURRENT, CUTOFF, TARGET, THIS_WEEK, TRAINING_ROWS, lag_predicate, table, with_tables
from matchday.registry.storage import GAME, ODDS

FROM_GAMES = "int_schedules"
LAG_TARGETS = tuple(range(1, 23))


@query("flt_training", table(FROM_GAMES, GAME, TRAINING_ROWS))
def flt_training(i: Inputs) -> DataFrame:
    return i.games.where(P.training_rows(i.cfg)).select(*GAME)


@query("flt_target_week", table(FROM_GAMES, GAME, f"season = {CURRENT} AND week = {TARGET}"))
def flt_target_week(i: Inputs) -> DataFrame:
    return i.games.where(P.target_rows(i.cfg)).select(*GAME)


@query("flt_schedule", table(FROM_GAMES, GAME, f"season <= {CURRENT} AND week <= {THIS_WEEK}"))
def flt_schedule(i: Inputs) -> DataFrame:
    return i.games.where(P.schedule_rows(i.cfg)).select(*GAME)


@query(
    "flt_schedule_current_only",
    table(FROM_GAMES, GAME, f"season < {CURRENT} OR (season = {CURRENT} AND week <= {THIS_WEEK})"),
)
def flt_schedule_current_only(i: Inputs) -> DataFrame:
    return i.games.where(P.schedule_rows(i.cfg, current_season_only=True)).select(*GAME)


@query("flt_prior_season", table(FROM_GAMES, GAME, f"season = {CURRENT - 1} AND week >= 1"))
def flt_prior_season(i: Inputs) -> DataFrame:
    return i.games.where(P.prior_season_rows(i.cfg, min_week=1)).select(*GAME)


_LAG_ROWS = " UNION ALL ".join(
    f"SELECT {w} AS target_week, recent_team, season, season_type, week FROM int_team_stats WHERE {lag_predicate(CURRENT, w)}"
    for w in LAG_TARGETS
)


@query("flt_lag_window", with_tables(_LAG_ROWS, "int_team_stats"))
def flt_lag_window(i: Inputs) -> DataFrame:
    keys = ["recent_team", "season", "season_type", "week"]
    windows = {w: P.lag_rows(replace(i.cfg, target_week=w)) for w in LAG_TARGETS}
    feeds_week = F.explode(F.array(*[F.when(rows, F.lit(w)) for w, rows in windows.items()]))
    used = i.team_stats.select(*keys).where(reduce(or_, windows.values()))
    return used.select(feeds_week.alias("target_week"), *keys).where("target_week IS NOT NULL")


_CALENDAR = """
SELECT c.* FROM lag_window AS c
JOIN (SELECT DISTINCT season, week FROM stg_schedules) AS p ON p.season = c.target_season AND p.week = c.target_week
"""


@query("lag_calendar", with_tables(_CALENDAR, "lag_window"))
def lag_calendar_of_games(i: Inputs) -> DataFrame:
    return lag_calendar(distinct_periods(i.games), i.cfg.lag, i.cfg.last_regular_week)


@query("flt_history", table(FROM_GAMES, GAME, f"season <= {CURRENT} AND week <= {TARGET - 1}"))
def flt_history(i: Inputs) -> DataFrame:
    return i.games.where(P.history_rows(i.cfg)).select(*GAME)


@query("flt_cutoff_week", table(FROM_GAMES, GAME, f"week <= {CUTOFF}"))
def flt_cutoff_week(i: Inputs) -> DataFrame:
    return i.games.where(P.cutoff_rows(CUTOFF)).select(*GAME)


@query("flt_cutoff_week_exclusive", table(FROM_GAMES, GAME, f"week < {CUTOFF}"))
def flt_cutoff_week_exclusive(i: Inputs) -> DataFrame:
    return i.games.where(P.cutoff_rows(CUTOFF, inclusive=False)).select(*GAME)


@query("flt_any_null", table(FROM_GAMES, [*GAME, *ODDS], " OR ".join(f"{c} IS NULL" for c in ODDS)))
def flt_any_null(i: Inputs) -> DataFrame:
    return i.games.where(P.any_null(ODDS)).select(*GAME, *ODDS)


_GUARD = f"""
SELECT t.season, t.week, count(*) AS games,
       CAST((SELECT count(*) FROM int_schedules AS h
             WHERE h.season < t.season OR (h.season = t.season AND h.week < t.week)) AS BIGINT) AS training_rows
FROM int_schedules AS t
WHERE EXISTS (SELECT 1 FROM int_schedules AS h WHERE h.season < t.season OR (h.season = t.season AND h.week < t.week))
GROUP BY t.season, t.week
"""


@query("flt_nonempty_guard", with_tables(_GUARD, "int_schedules"))
def flt_nonempty_guard(i: Inputs) -> DataFrame:
    before = expanding_totals(i.games, [], {}).where("rows_before > 0")
    before = before.select(F.col("season").alias(KEY + "s"), F.col("week").alias(KEY + "w"), "rows_before")
    sizes = period_sizes(i.games)
    return sizes.join(before, (F.col("season") == F.col(KEY + "s")) & (F.col("week") == F.col(KEY + "w"))).select(
        "season", "week", F.col("rows").alias("games"), F.col("rows_before").alias("training_rows")
    )
