"""Run settings and the column contracts shared by all stages."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

# ---------------------------------------------------------------------------------------------
# Fixed values. These names are the data model: results are only comparable if they are kept.
# ---------------------------------------------------------------------------------------------

# Raw statistics of one entity member in one period, in feed order.
MEASURES = (
    "passing_yards", "rushing_yards", "receiving_yards",
    "passing_tds", "rushing_tds", "receiving_tds", "special_teams_tds",
    "interceptions", "sacks", "rushing_fumbles", "receiving_fumbles",
    "rushing_first_downs", "receiving_first_downs",
    "carries", "targets", "receptions",
    "passing_2pt_conversions", "rushing_2pt_conversions", "receiving_2pt_conversions",
    "completions", "attempts",
    "sack_yards", "sack_fumbles", "sack_fumbles_lost",
    "passing_air_yards", "passing_yards_after_catch", "passing_first_downs",
    "rushing_fumbles_lost", "receiving_fumbles_lost",
    "receiving_air_yards", "receiving_yards_after_catch",
)

# Grain of the team-period fact.
TEAM_KEYS = ("recent_team", "season", "season_type", "week")

# Measures summed by the simple (fill-with-zero) team-week aggregation.
WEEKLY_MEASURES = (
    "passing_yards", "rushing_yards", "passing_tds", "rushing_tds", "interceptions", "sacks",
    "rushing_fumbles", "receiving_tds", "special_teams_tds", "carries", "targets", "receptions",
    "receiving_yards", "passing_2pt_conversions", "rushing_2pt_conversions",
)

# Measures derived from the summed ones.
DERIVED_MEASURES = (
    "touchdowns", "2pt_conversions", "total_score", "total_yards_offense", "turnovers_offense",
)

# Schedule columns kept by the simple transform.
SCHEDULE_COLUMNS = (
    "game_id", "season", "season_type", "week", "home_team", "away_team",
    "home_score", "away_score", "away_rest", "home_rest", "away_moneyline", "home_moneyline",
    "spread_line", "away_spread_odds", "home_spread_odds", "total_line", "under_odds",
    "over_odds", "div_game",
)

# Schedule columns that pass through the cleaned schedule unchanged.
SCHEDULE_PASS_THROUGH = (
    "location", "total", "overtime", "away_rest", "home_rest", "away_moneyline",
    "home_moneyline", "spread_line", "away_spread_odds", "home_spread_odds", "total_line",
    "under_odds", "over_odds", "div_game", "roof", "surface", "temp", "wind",
    "away_qb_id", "home_qb_id", "away_qb_name", "home_qb_name", "away_coach", "home_coach",
    "referee", "stadium_id", "stadium",
)

# Model features known before a game is played.
GAME_FEATURES = (
    "season", "week", "game_type_num", "home_rest", "away_rest", "home_moneyline",
    "away_moneyline", "spread_line", "home_spread_odds", "away_spread_odds", "total_line",
    "under_odds", "over_odds", "div_game",
)

# Model features taken from each side's statistics.
SIDE_FEATURES = (
    "passing_yards", "rushing_yards", "receiving_yards", "sacks", "rushing_fumbles",
    "receiving_fumbles", "sack_fumbles", "interceptions", "targets", "carries", "receptions",
)

# Statistics attached to each side of the wide weekly score table.
SCORE_SIDE_MEASURES = (
    "passing_yards", "rushing_yards", "passing_tds", "rushing_tds", "interceptions", "sacks",
    "rushing_fumbles", "receiving_tds", "special_teams_tds", "carries", "targets", "receptions",
    "receiving_yards", "passing_2pt_conversions", "rushing_2pt_conversions", "touchdown_points",
)

# Trailing window: output name -> source measure, averaged.
LAG_AVERAGES = {
    "passing_yards_avg": "passing_yards",
    "rushing_yards_avg": "rushing_yards",
    "receiving_yards_avg": "receiving_yards",
    "avg_receptions": "receptions",
    "avg_targets": "targets",
    "avg_carries": "carries",
    "touchdown_points": "touchdown_points",
    "receiving_tds": "receiving_tds",
}

# Trailing window: measures summed under their own name.
LAG_TOTALS = (
    "passing_tds", "rushing_tds", "special_teams_tds", "interceptions", "sacks",
    "rushing_fumbles", "receiving_fumbles", "sack_fumbles",
    "passing_2pt_conversions", "rushing_2pt_conversions",
)

# Side feature -> column of the trailing profile that supplies it.
LAG_FEATURE_SOURCE = {
    "passing_yards": "passing_yards_avg",
    "rushing_yards": "rushing_yards_avg",
    "receiving_yards": "receiving_yards_avg",
    "sacks": "sacks",
    "rushing_fumbles": "rushing_fumbles",
    "receiving_fumbles": "receiving_fumbles",
    "sack_fumbles": "sack_fumbles",
    "interceptions": "interceptions",
    "targets": "avg_targets",
    "carries": "avg_carries",
    "receptions": "avg_receptions",
}

# Historical side profile: measure -> statistic.
PROFILE_SPEC = {
    "passing_yards": "mean",
    "rushing_yards": "mean",
    "sacks": "mean",
    "total_score": "mean",
    "carries": "mean",
    "receiving_yards": "mean",
    "targets": "median",
    "receptions": "median",
    "passing_tds": "sum",
    "rushing_tds": "sum",
    "receiving_tds": "sum",
    "turnovers_offense": "sum",
    "interceptions": "sum",
    "rushing_fumbles": "sum",
    "special_teams_tds": "sum",
    "total_yards_offense": "mean",
}

# Game type -> season type; anything else has no season type.
SEASON_TYPE_OF_GAME_TYPE = {
    "REG": "REG", "POST": "POST", "WC": "POST", "DIV": "POST", "CON": "POST", "SB": "POST",
}

# Columns that identify a game or leak its result; never model features.
NON_FEATURES = (
    "game_id", "home_team", "away_team", "outcome", "score_diff", "game_total_points",
)

# Team code that replaces a missing or relocated one.
RELOCATED_TEAM = "OAK"
TEAM_FALLBACK = "LV"

# ---------------------------------------------------------------------------------------------

HOME, AWAY = "_home", "_away"


def both_sides(names) -> list[str]:
    """Side column names, all home ones first."""
    return [n + HOME for n in names] + [n + AWAY for n in names]


TRAINING_FEATURES = [*GAME_FEATURES, *both_sides(SIDE_FEATURES)]


@dataclass(frozen=True)
class SeasonConfig:
    """Which seasons exist, which one is being predicted, and how the calendar works.

    ``as_of`` replaces the wall clock, so that every result can be reproduced.
    """

    seasons: tuple[int, ...] = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
    current_season: int = 2000
    season_start: date = date(2000, 1, 1)
    as_of: date = date(2000, 3, 27)
    target_week: int = 13
    cutoff_week: int = 12
    lag: int = 3
    last_regular_week: int = 18
    last_week: int = 22

    def for_week(self, week: int) -> "SeasonConfig":
        """The same season with ``week`` as target and everything before it as history."""
        return replace(self, target_week=week, cutoff_week=week - 1)
