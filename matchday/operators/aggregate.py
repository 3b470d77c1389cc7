"""Group aggregations of team statistics and games."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.config import AWAY, HOME, MEASURES, TEAM_KEYS, WEEKLY_MEASURES
from matchday.functions import scalars as S
from matchday.functions.projections import fill_zero, q
from matchday.operators.joins import KEY, join_sides, unpivot_sides
from matchday.operators.quantiles import exact_percentiles
from matchday.operators.skew import DEFAULT_POLICY, SkewPolicy


def team_week_filled(weekly: DataFrame, measures: Sequence[str] = WEEKLY_MEASURES) -> DataFrame:
    """Sum per team, season, season type and week, after every NULL became 0.

    A missing team or season type is a group of its own, keyed ``'0'``.
    """
    rows = fill_zero(weekly.select(*TEAM_KEYS, *measures))
    return rows.groupBy(*TEAM_KEYS).agg(*[F.sum(m).alias(m) for m in measures])


def team_week(weekly: DataFrame) -> DataFrame:
    """Sum per team, season, season type and week; NULLs are ignored, not replaced."""
    scored = S.scored_touchdowns()
    return weekly.groupBy(*TEAM_KEYS).agg(
        (scored * 6).alias("touchdown_points"),
        scored.alias("touchdowns_scored"),
        *[F.sum(m).alias(m) for m in MEASURES],
    )


def score_data(games: DataFrame, team_stats: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Scores, touchdown points and the remaining (kicking) points per pairing and period.

    Games are summed per pairing and game type *before* the joins. That is exact because the
    statistics hold one row per team, period and season type, and it keeps the shuffles at the
    size of the distinct pairings. Season type is compared with game type as stored.
    """
    pairings = games.groupBy("season", "week", "home_team", "away_team", "game_type").agg(
        F.sum("home_score").alias("home_score"),
        F.sum("away_score").alias("away_score"),
        F.count(F.lit(1)).alias("games"),
    )
    typed = join_sides(
        pairings,
        team_stats,
        ["touchdown_points"],
        on=[("week", "week"), ("season", "season"), ("game_type", "season_type")],
        spread_by=["home_team", "away_team"],
        policy=policy,
    )

    def touchdown_points(side: str):
        return F.coalesce(F.sum(q(f"touchdown_points{side}") * q("games")), F.lit(0.0))

    sums = typed.groupBy("season", "week", "home_team", "away_team").agg(
        F.sum("home_score").alias("home_score"),
        F.sum("away_score").alias("away_score"),
        touchdown_points(HOME).alias("home_touchdown_points"),
        touchdown_points(AWAY).alias("away_touchdown_points"),
    )
    return sums.select(
        "*",
        (q("home_score") - q("home_touchdown_points")).alias("home_kicking_points"),
        (q("away_score") - q("away_touchdown_points")).alias("away_kicking_points"),
    )


def kicking_stats(scores: DataFrame) -> DataFrame:
    """Kicking points of each side: one row per team and pairing."""
    return unpivot_sides(
        scores, ["season", "week"], kicking_points=("home_kicking_points", "away_kicking_points")
    )


def kicking_counts(games: DataFrame) -> DataFrame:
    """How many kicking rows a team has in a period, without computing them.

    Every distinct pairing yields one row per side, so counting pairings is enough.
    """
    pairings = games.select("season", "week", "home_team", "away_team").distinct()
    sides = unpivot_sides(pairings, ["season", "week"])
    return sides.groupBy("team", "season", "week").agg(F.count(F.lit(1)).alias("kicking_rows"))


_PLAIN = {"mean": F.avg, "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0))}


def profile(df: DataFrame, keys: Sequence[str], spec: Mapping[str, str]) -> DataFrame:
    """Mean, median or sum of columns per group; rows without a key are left out.

    Sums of nothing are 0, means and medians skip NULLs. Medians are exact and computed without
    gathering a group in one task; they read ``df`` a second time.
    """
    rows = df.dropna(subset=list(keys))
    plain = [_PLAIN[how](q(c)).alias(c) for c, how in spec.items() if how != "median"]
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(KEY + "rows"), *plain)
    medians = [c for c, how in spec.items() if how == "median"]
    if medians:
        half = exact_percentiles(rows, keys, medians, [0.5])
        wide = half.groupBy(*keys).agg(*[F.max(F.when(q("metric") == c, q("p50"))).alias(c) for c in medians])
        out = out.join(wide, list(keys), "left")
    return out.select(*keys, *spec)


def side_profiles(games: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Profile per ``(side, team)``: home teams from home games, away teams from away games.

    ``games`` holds each measure once per side. Both sides go through one aggregation.
    """
    marked = games.select("*", F.lit("home").alias(KEY + HOME), F.lit("away").alias(KEY + AWAY))
    rows = unpivot_sides(marked, [], side=(KEY + HOME, KEY + AWAY), **{c: (c + HOME, c + AWAY) for c in spec})
    return profile(rows, ["side", "team"], spec)


def mean_profile(weekly: DataFrame, measures: Sequence[str] = WEEKLY_MEASURES) -> DataFrame:
    """Mean of every measure per team."""
    return profile(weekly, ["recent_team"], {m: "mean" for m in measures})


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that contain NULLs and how many, from one aggregation."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(q(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), q(c).alias("null_count")) for c in columns]
    return counted.select(F.inline(F.array(*rows))).where("null_count > 0")
