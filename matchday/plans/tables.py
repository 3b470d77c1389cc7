"""Derived tables, each a pure function from DataFrames to a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.config import (
    AWAY,
    GAME_FEATURES,
    HOME,
    MEASURES,
    SCHEDULE_COLUMNS,
    SCHEDULE_PASS_THROUGH,
    SCORE_SIDE_MEASURES,
    SIDE_FEATURES,
    SeasonConfig,
    both_sides,
)
from matchday.functions import scalars as S
from matchday.functions.predicates import schedule_rows
from matchday.functions.projections import q, with_derived_measures, with_game_totals
from matchday.operators import aggregate as A
from matchday.operators.joins import KEY, join_result, join_sides, unpivot_sides
from matchday.operators.skew import DEFAULT_POLICY, SkewPolicy, keyed_join

REPEAT = "__repeat"
COPY_BLOCK = 65_536
PERIOD_OF_TEAM = ("team", "season", "week")


def clean_schedule(games: DataFrame, regular_code: str = "reg") -> DataFrame:
    """Normalised schedule with type flags, outcome and winner.

    ``regular_code`` is compared case-sensitively; the default is the code as originally written,
    feeds that say ``REG`` need ``regular_code="REG"``. The winner keeps the *raw* team code, so a
    relocated or missing team never equals it.
    """
    home, away = q("home_score"), q("away_score")
    return games.select(
        "game_id",
        "season",
        "game_type",
        S.game_type_group(q("game_type"), regular_code).alias("game_type_group"),
        S.game_type_num(q("game_type"), regular_code).alias("game_type_num"),
        "week",
        "gameday",
        "weekday",
        "gametime",
        S.normal_team(q("away_team")).alias("away_team"),
        "away_score",
        S.normal_team(q("home_team")).alias("home_team"),
        "home_score",
        S.home_won(home, away).alias("outcome"),
        S.winner(home, away, q("home_team"), q("away_team")).alias("winner"),
        *SCHEDULE_PASS_THROUGH,
    )


def simple_schedule(games: DataFrame, cfg: SeasonConfig, current_season_only: bool = False) -> DataFrame:
    """Games up to ``cfg.as_of`` with recoded season type, contract columns and outcome."""
    played = games.where(schedule_rows(cfg, current_season_only))
    typed = played.withColumn("season_type", S.season_type(q("game_type")))
    return with_game_totals(typed.select(*SCHEDULE_COLUMNS), score_diff=False)


def simple_weekly_scores(weekly: DataFrame) -> DataFrame:
    """Team-week sums over zero-filled rows, with the derived measures."""
    return with_derived_measures(A.team_week_filled(weekly))


def base_model(
    schedule: DataFrame, weekly_scores: DataFrame, null_safe: bool = True, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Games with both sides' weekly scores, outcome, total points and score difference.

    ``null_safe`` lets NULL keys match NULL keys.
    """
    measures = [c for c in weekly_scores.columns if c not in ("recent_team", "season", "season_type", "week")]
    joined = join_sides(
        schedule,
        weekly_scores,
        measures,
        on=[("season", "season"), ("week", "week"), ("season_type", "season_type")],
        null_safe=null_safe,
        policy=policy,
    )
    return with_game_totals(joined)


def winners_by_side(games: DataFrame) -> DataFrame:
    """One row per team and game with the game's winner."""
    return unpivot_sides(games, ["game_id", "season", "week", "winner"], team="recent_team")


def team_results(team_stats: DataFrame, games: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Team-week statistics with the result of each game of that week."""
    joined = join_result(team_stats, winners_by_side(games), policy)
    return joined.select(
        "recent_team",
        S.win_or_loss(q("winner"), q("recent_team")).alias("result"),
        "season",
        "season_type",
        "week",
        "touchdown_points",
        "touchdowns_scored",
        *MEASURES,
    )


def _with_kicking_rows(team_stats: DataFrame, kicking: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistics of a side with its kicking rows; a team-period without any keeps one row."""
    right = kicking.withColumnsRenamed({c: KEY + c for c in PERIOD_OF_TEAM})
    side = keyed_join(team_stats, right, _team_period())
    return side.select("recent_team", "season", "week", *columns, F.coalesce(q("kicking_rows"), F.lit(1)).alias(REPEAT))


def _team_period(prefix: str = KEY) -> list[tuple[str, str]]:
    return [("recent_team", prefix + "team"), ("season", prefix + "season"), ("week", prefix + "week")]


def _repeated(joined: DataFrame, columns: Sequence[str], weight: str | None) -> DataFrame:
    """Each row as often as its two sides' kicking rows multiply, or once with that number.

    Copies are made in blocks, so no row ever holds one long array.
    """
    times = F.coalesce(q(REPEAT + HOME), F.lit(1)) * F.coalesce(q(REPEAT + AWAY), F.lit(1))
    rows = joined.select(*columns, times.alias(weight or REPEAT))
    if weight:
        return rows
    one, block = F.lit(1).cast("long"), F.lit(COPY_BLOCK).cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((q(REPEAT) - 1) / block))
    blocked = rows.select(*columns, REPEAT, F.explode(blocks).alias("__block"))
    copies = F.sequence(one, F.least(block, q(REPEAT) - q("__block") * block))
    return blocked.select(*columns, F.explode(copies).alias("__copy")).drop("__copy")


def weekly_score_rows(
    games: DataFrame,
    team_stats: DataFrame,
    columns: Sequence[str] = (*SCORE_SIDE_MEASURES, "kicking_points"),
    keep: Sequence[str] | None = None,
    weight: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Games with both sides' statistics and kicking points.

    A team with several pairings in one period has several kicking rows, and a game repeats for
    each combination. Equal kicking points are counted before the joins and repeated at the very
    end, or, with ``weight``, left as one row that carries its multiplicity.
    """
    kicking = A.kicking_stats(A.score_data(games, team_stats, policy))
    counted = kicking.groupBy("team", "season", "week", "kicking_points").agg(F.count(F.lit(1)).alias("kicking_rows"))
    sides = _with_kicking_rows(team_stats, counted, columns)
    joined = join_sides(games, sides, [*columns, REPEAT], policy=policy)
    return _repeated(joined, [*(_game_columns() if keep is None else keep), *both_sides(columns)], weight)


def _game_columns() -> list[str]:
    return ["season", "week", "home_team", "away_team", "outcome", *[c for c in GAME_FEATURES if c not in ("season", "week")]]


def training_data(
    games: DataFrame,
    team_stats: DataFrame,
    weight: str | None = None,
    keep: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Model features of every game with its outcome and both teams.

    The kicking rows decide only how often a game repeats. That number follows from the pairings
    alone, so neither their points nor the row-multiplying joins are computed. ``weight`` returns
    each distinct row once with its multiplicity, which a model takes as weight.
    """
    sides = _with_kicking_rows(team_stats, A.kicking_counts(games), SIDE_FEATURES)
    joined = join_sides(games, sides, [*SIDE_FEATURES, REPEAT], policy=policy)
    return _repeated(joined, [*keep, *_game_columns(), *both_sides(SIDE_FEATURES)], weight)
