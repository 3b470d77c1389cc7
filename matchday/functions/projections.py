"""Frame-level projections: which columns a stage carries and under which names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.config import AWAY, HOME
from matchday.functions import scalars as S


def q(name: str) -> Column:
    """Column by exact name; also for names that start with a digit."""
    return F.col(f"`{name}`")


def fill_zero(df: DataFrame) -> DataFrame:
    """NULL becomes 0 in every column, also in string keys (there ``'0'``)."""
    return df.fillna(0).fillna("0")


def with_derived_measures(stats: DataFrame, keep_parts: bool = True) -> DataFrame:
    """Points, yards and turnovers derived from the summed measures.

    ``keep_parts=False`` drops the helper columns, as an older form of the table did.
    """
    touchdowns = 6 * (q("passing_tds") + q("rushing_tds") + q("special_teams_tds"))
    conversions = 2 * (q("passing_2pt_conversions") + q("rushing_2pt_conversions"))
    out = stats.select(
        "*",
        touchdowns.alias("touchdowns"),
        conversions.alias("2pt_conversions"),
        (touchdowns + conversions).alias("total_score"),
        (q("passing_yards") + q("rushing_yards")).alias("total_yards_offense"),
        (q("interceptions") + q("rushing_fumbles")).alias("turnovers_offense"),
    )
    if keep_parts:
        return out
    return out.drop(
        "passing_2pt_conversions", "rushing_2pt_conversions", "touchdowns", "2pt_conversions"
    )


def with_game_totals(games: DataFrame, score_diff: bool = True) -> DataFrame:
    """Outcome, total points and (optionally) the score difference."""
    home, away = q("home_score"), q("away_score")
    extra = [S.home_won(home, away).alias("outcome"), (home + away).alias("game_total_points")]
    if score_diff:
        extra.append((home - away).alias("score_diff"))
    keep = [q(c) for c in games.columns if c not in {"outcome", "game_total_points", "score_diff"}]
    return games.select(*keep, *extra)


def strip_suffix(df: DataFrame, key: str, suffix: str, key_name: str = "team") -> DataFrame:
    """Rename the group key, then remove ``suffix`` from every column name."""
    names = [key_name if c == key else c.replace(suffix, "") for c in df.columns]
    return df.toDF(*names)


def suffixed(columns: Iterable[str], suffix: str) -> list[Column]:
    return [q(c).alias(c + suffix) for c in columns]


def side_columns(home: DataFrame, away: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Overlapping columns of two frames, told apart by side suffix."""
    return [home[f"`{c}`"].alias(c + HOME) for c in columns] + [
        away[f"`{c}`"].alias(c + AWAY) for c in columns
    ]


def drop_columns(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop columns; ``strict`` raises if one is absent."""
    columns = list(columns)
    absent = [c for c in columns if c not in df.columns]
    if strict and absent:
        raise ValueError(f"columns not found: {absent}")
    return df.drop(*columns)


def reindex(df: DataFrame, columns: Iterable[str], fill: object = 0) -> DataFrame:
    """Exactly ``columns``: absent ones hold ``fill``, NULLs in present ones stay."""
    present = set(df.columns)
    return df.select(*[q(c) if c in present else F.lit(fill).alias(c) for c in columns])


def first_of_each_name(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with the same name."""
    names, picked = set(), []
    for position, name in enumerate(df.columns):
        if name not in names:
            names.add(name)
            picked.append((position, name))
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"c{i}").alias(name) for i, name in picked])


def mask_label(games: DataFrame, columns: Sequence[str] = ("home_score", "away_score")) -> DataFrame:
    """Hide the result of games that are to be predicted."""
    types = {f.name: f.dataType for f in games.schema.fields}
    return games.withColumns({c: F.lit(0).cast(types.get(c, T.DoubleType())) for c in columns})


def schema_diff(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """One row per column name: is it available, expected, missing, and how many values it holds."""
    available, expected = set(df.columns), set(expected)
    names = sorted(available | expected)
    counts = df.agg(*[F.count(q(c)).alias(c) for c in sorted(available)])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in available).alias("available"),
            F.lit(c in expected).alias("expected"),
            F.lit(c not in available).alias("missing"),
            (q(c) if c in available else F.lit(0).cast("long")).alias("filled_rows"),
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*rows)))
