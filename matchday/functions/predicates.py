"""Row predicates over ``season`` and ``week``.

Each returns a boolean ``Column`` built from comparisons joined with logical AND / OR, so that it
reaches the parquet scan, or prunes partitions where a table is partitioned by period.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchday.config import SeasonConfig
from matchday.functions.calendar import lag_periods, week_number


def in_period(season: int, week: int) -> Column:
    return (F.col("season") == season) & (F.col("week") == week)


def training_rows(cfg: SeasonConfig) -> Column:
    """Everything before the current season, and the current season up to the cutoff week.

    A past-season row with a NULL week is kept: ``true OR NULL`` is true.
    """
    current = (F.col("season") == cfg.current_season) & (F.col("week") <= cfg.cutoff_week)
    return (F.col("season") < cfg.current_season) | current


def target_rows(cfg: SeasonConfig) -> Column:
    return in_period(cfg.current_season, cfg.target_week)


def schedule_rows(cfg: SeasonConfig, current_season_only: bool = False) -> Column:
    """Games up to the week of ``cfg.as_of``.

    The week bound holds in every season, also past ones. ``current_season_only`` keeps past
    seasons whole instead.
    """
    season, week = F.col("season"), F.col("week")
    bound = week <= week_number(cfg.as_of, cfg.season_start)
    if current_season_only:
        return (season < cfg.current_season) | ((season == cfg.current_season) & bound)
    return (season <= cfg.current_season) & bound


def prior_season_rows(cfg: SeasonConfig, min_week: int | None = None) -> Column:
    """Previous season only: the training set of week 1."""
    prior = F.col("season") == cfg.current_season - 1
    return prior if min_week is None else prior & (F.col("week") >= min_week)


def walk_forward_rows(cfg: SeasonConfig) -> Column:
    """Training rows of one walk-forward step."""
    return prior_season_rows(cfg) if cfg.target_week == 1 else training_rows(cfg)


def lag_rows(cfg: SeasonConfig) -> Column:
    """Rows in the trailing window of the one target week in ``cfg``."""
    periods = lag_periods(cfg.current_season, cfg.target_week, cfg.lag, cfg.last_regular_week)
    return reduce(or_, (in_period(s, w) for s, w in periods))


def history_rows(cfg: SeasonConfig) -> Column:
    """Weeks before the target week, in all seasons up to the current one."""
    return (F.col("season") <= cfg.current_season) & (F.col("week") <= cfg.target_week - 1)


def cutoff_rows(week: int, inclusive: bool = True) -> Column:
    return F.col("week") <= week if inclusive else F.col("week") < week


def any_null(columns: Iterable[str]) -> Column:
    """True where at least one of ``columns`` is NULL."""
    return reduce(or_, (F.col(f"`{c}`").isNull() for c in columns), F.lit(False))
