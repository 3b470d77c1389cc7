"""Period arithmetic: week of season, and which earlier periods feed a target period."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def week_number(as_of: date, season_start: date) -> int:
    """Week of the season on ``as_of``; at least 1."""
    days = (as_of - season_start).days
    return max(1, -(-days // 7))


def week_of_season(day: Column, season_start: date) -> Column:
    """Column form of :func:`week_number`."""
    elapsed = F.datediff(day, F.lit(season_start))
    return F.greatest(F.lit(1), F.ceil(elapsed / F.lit(7.0)).cast("int")).cast("int")


def lag_periods(season: int, week: int, lag: int = 3, last_regular_week: int = 18) -> list[tuple[int, int]]:
    """The ``lag`` calendar periods before one target period.

    Before week 1 the window continues at the last *regular* week of the previous season, so
    playoff weeks never feed the start of a season.
    """
    if lag > last_regular_week:
        raise ValueError(f"a window of {lag} weeks is longer than the {last_regular_week} weeks of a season")
    earlier = (week - back for back in range(1, lag + 1))
    return [(season, w) if w >= 1 else (season - 1, last_regular_week + w) for w in earlier]


def lag_calendar(targets: DataFrame, lag: int = 3, last_regular_week: int = 18) -> DataFrame:
    """``(target_season, target_week, season, week)`` for every ``(season, week)`` in ``targets``."""
    back = targets.select(
        F.col("season").alias("target_season"),
        F.col("week").alias("target_week"),
        F.explode(F.sequence(F.lit(1), F.lit(lag))).alias("back"),
    )
    week = F.col("target_week") - F.col("back")
    crosses = week < 1
    return back.select(
        "target_season",
        "target_week",
        (F.col("target_season") - crosses.cast("int")).cast("int").alias("season"),
        F.when(crosses, week + last_regular_week).otherwise(week).cast("int").alias("week"),
    )


def lag_targets(
    season: Column, week: Column, lag: int = 3, last_regular_week: int = 18, last_week: int = 22
) -> Column:
    """All target periods that a row of period ``(season, week)`` feeds, as an array of structs.

    Entries beyond the calendar are NULL. This is :func:`lag_calendar` read from the other end. Exploding it is a narrow, map-side
    operation, so a trailing window over all targets needs no calendar join.
    """

    def period(s: Column, w: Column) -> Column:
        return F.struct(s.cast("int").alias("season"), w.cast("int").alias("week"))

    def same_season(ahead: int) -> Column:
        return F.when(week + ahead <= last_week, period(season, week + ahead))

    def next_season(ahead: int) -> Column:
        target = week + ahead - last_regular_week
        return F.when((week <= last_regular_week) & (target >= 1), period(season + 1, target))

    steps = range(1, lag + 1)
    return F.array(*[same_season(i) for i in steps], *[next_season(i) for i in steps])


#: Lane of the regular weeks of all seasons, one after another. The last weeks of a season have a lane of their own.
REGULAR_LANE = 0


def period_lanes(season: Column, week: Column, lag: int = 3, last_regular_week: int = 18, last_week: int = 22) -> Column:
    """Where a row of period ``(season, week)`` stands, as an array of structs (lane, ordinal).

    Regular weeks are numbered through all seasons, so week 1 follows the last regular week before it. Weeks
    beyond would take the numbers of the next season; they stand in a lane for each season, together
    with the regular weeks that their windows reach.
    """

    def place(lane: Column, ordinal: Column) -> Column:
        return F.struct(lane.cast("int").alias("lane"), ordinal.cast("int").alias("ordinal"))

    regular = F.when(week.between(1, last_regular_week), place(F.lit(REGULAR_LANE), season * last_regular_week + week))
    late = F.when(week.between(last_regular_week + 1 - lag, last_week), place(season, week))
    return F.filter(F.array(regular, late), lambda x: x.isNotNull())


def target_periods(first_season: Column, last_season: Column, last_regular_week: int = 18, last_week: int = 22) -> Column:
    """All periods of the seasons, as an array of structs (season, week, lane, ordinal) at which a window may end."""

    def of_season(season: Column) -> Column:
        def period(week: Column) -> Column:
            regular = week <= last_regular_week
            return F.struct(
                season.cast("int").alias("season"),
                week.cast("int").alias("week"),
                F.when(regular, F.lit(REGULAR_LANE)).otherwise(season).cast("int").alias("lane"),
                F.when(regular, season * last_regular_week + week).otherwise(week).cast("int").alias("ordinal"),
            )

        return F.transform(F.sequence(F.lit(1), F.lit(last_week)), period)

    return F.flatten(F.transform(F.sequence(first_season, last_season), of_season))
