"""Scalar expressions on game and statistics rows."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchday.config import RELOCATED_TEAM, SEASON_TYPE_OF_GAME_TYPE, TEAM_FALLBACK


def recode(value: Column, mapping: Mapping[str, object]) -> Column:
    """Dictionary lookup; a value without entry becomes NULL."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*pairs), value)


def season_type(game_type: Column) -> Column:
    return recode(game_type, SEASON_TYPE_OF_GAME_TYPE)


def season_type_else_post(game_type: Column) -> Column:
    """Older rule: everything that is not a regular game, also NULL, is post-season."""
    return F.when(game_type == "REG", F.lit("REG")).otherwise(F.lit("POST"))


def season_type_code(value: Column) -> Column:
    """Label encoding used by the model: REG 0, POST 1, anything else NULL."""
    return F.when(value == "REG", F.lit(0)).when(value == "POST", F.lit(1))


def game_type_group(game_type: Column, regular_code: str) -> Column:
    return F.when(game_type == regular_code, F.lit("reg")).otherwise(F.lit("post"))


def game_type_num(game_type: Column, regular_code: str) -> Column:
    return F.when(game_type == regular_code, F.lit(0)).otherwise(F.lit(1))


def normal_team(code: Column, relocated: str = RELOCATED_TEAM, fallback: str = TEAM_FALLBACK) -> Column:
    """Replace a missing or relocated team code."""
    return F.when(code.isNull() | (code == relocated), F.lit(fallback)).otherwise(code)


def home_won(home_score: Column, away_score: Column) -> Column:
    """1 if the home side scored more; ties and unplayed games are 0."""
    return F.when(home_score > away_score, F.lit(1)).otherwise(F.lit(0))


def winner(home_score: Column, away_score: Column, home_team: Column, away_team: Column) -> Column:
    return F.when(home_score > away_score, home_team).otherwise(away_team)


def win_or_loss(winning_team: Column, team: Column) -> Column:
    return F.when(winning_team == team, F.lit("win")).otherwise(F.lit("loss"))


def scored_touchdowns() -> Column:
    """Rushing, receiving and special-teams touchdowns of a group; NULL if any sum is NULL."""
    return F.sum("rushing_tds") + F.sum("receiving_tds") + F.sum("special_teams_tds")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is 0."""
    return F.try_divide(numerator, denominator)
