"""Two-sided joins of games with team statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.config import AWAY, HOME
from matchday.functions.projections import q
from matchday.operators.skew import DEFAULT_POLICY, SkewPolicy, salted_join

KEY = "__key_"


def _side(stats: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str, key_suffix: str) -> DataFrame:
    """Right side of one join: its keys under private names, its columns under suffixed ones."""
    return stats.select(
        *[q(k).alias(f"{KEY}{k}{key_suffix}") for k in keys], *[q(c).alias(c + suffix) for c in columns]
    )


def join_sides(
    games: DataFrame,
    stats: DataFrame,
    columns: Sequence[str],
    on: Sequence[tuple[str, str]] = (("season", "season"), ("week", "week")),
    team: str = "recent_team",
    spread_by: Sequence[str] = ("game_id",),
    null_safe: bool = False,
    suffixes: tuple[str, str] = (HOME, AWAY),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``games`` left-joined with ``stats`` of the home side and of the away side.

    ``on`` pairs game columns with statistics columns, next to the team itself. Both joins read the
    same ``stats`` columns under the same keys, so Spark computes and shuffles ``stats`` once.
    """
    stat_keys = [team, *[s for _, s in on]]
    out = games
    for side, suffix in zip(("home", "away"), suffixes):
        right = _side(stats, stat_keys, columns, suffix, "_" + side)
        pairs = [(f"{side}_team", f"{KEY}{team}_{side}")]
        pairs += [(g, f"{KEY}{s}_{side}") for g, s in on]
        out = salted_join(out, right, pairs, spread_by, "left", null_safe, policy)
        out = out.drop(*[r for _, r in pairs])
    return out


def join_result(
    stats: DataFrame, sides: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Statistics of a team with each game it played in the same period.

    ``sides`` has one row per team and game and is the many side of the join.
    """
    keys = ["recent_team", "season", "week"]
    many = sides.select(*[q(k).alias(KEY + k) for k in keys], *[q(c) for c in sides.columns if c not in keys])
    pairs = [(KEY + k, k) for k in keys]
    joined = salted_join(many, stats, pairs, ["game_id"], "inner", policy=policy)
    return joined.drop(*[KEY + k for k in keys])


def join_single_profile(
    games: DataFrame, profile: DataFrame, columns: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One profile per team joined to both sides; the home copy keeps plain names.

    The away copy is suffixed and keeps its team column, the home team column is dropped.
    """
    away = profile.withColumn("recent_team" + AWAY, q("recent_team"))
    right_home = _side(profile, ["recent_team"], columns, "", "_home")
    right_away = _side(away, ["recent_team"], [*columns, "recent_team"], AWAY, "_away")
    out = salted_join(games, right_home, [("home_team", KEY + "recent_team_home")], ["game_id"], policy=policy)
    out = salted_join(out, right_away, [("away_team", KEY + "recent_team_away")], ["game_id"], policy=policy)
    return out.drop(KEY + "recent_team_home", KEY + "recent_team_away")


def distinct_periods(df: DataFrame) -> DataFrame:
    return df.select("season", "week").distinct()


def unseen_periods(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``new`` whose ``(season, week)`` is not in ``stored``; NULL periods count as equal.

    The stored side is one row per period. Spark broadcasts it below its own size threshold, so the
    feed itself is normally not shuffled.
    """
    known = distinct_periods(stored).select(q("season").alias(KEY + "season"), q("week").alias(KEY + "week"))
    same = new["season"].eqNullSafe(known[KEY + "season"]) & new["week"].eqNullSafe(known[KEY + "week"])
    return new.join(known, same, "left_anti")


def unpivot_sides(games: DataFrame, shared: Sequence[str], team: str = "team", **per_side: tuple[str, str]) -> DataFrame:
    """One row per team and game from one scan of ``games``.

    ``shared`` columns are repeated; each keyword names an output column and the (home, away)
    columns that fill it.
    """
    def side(index: int, team_column: str):
        values = [q(pair[index]).alias(name) for name, pair in per_side.items()]
        return F.struct(q(team_column).alias(team), *values)

    both = games.select(*[q(c) for c in shared], F.explode(F.array(side(0, "home_team"), side(1, "away_team"))).alias("s"))
    return both.select(*[q(c) for c in shared], F.col(f"s.{team}"), *[F.col(f"s.{n}") for n in per_side])
