"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"


@dataclass(frozen=True)
class SkewPolicy:
    """How far the rows of every key are spread. One salt is the plain join.

    Spark splits skewed partitions of a plain join while it runs. Salts are for callers who know that
    a key is beyond what that can do: the many side gets ``salts`` groups, the other is repeated as
    often. Nothing depends on the size of a table, and no table is read to decide.
    """

    salts: int = 1


DEFAULT_POLICY = SkewPolicy()

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _comparable(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> None:
    """Refuses a text key against a number: the cast that Spark would add loses or merges keys."""
    kinds, others = dict(left.dtypes), dict(right.dtypes)
    for l, r in on:
        a, b = kinds[l], others[r]
        if "string" in (a, b) and (a.startswith(_NUMBERS) or b.startswith(_NUMBERS)):
            raise TypeError(f"cannot join {l} ({a}) with {r} ({b}): cast one of them")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on ``(left column, right column)`` pairs; both key columns stay in the result."""
    _comparable(left, right, on)

    def pair(l: str, r: str) -> Column:
        a, b = left[f"`{l}`"], right[f"`{r}`"]
        return a.eqNullSafe(b) if null_safe else a == b

    return left.join(right, reduce(and_, (pair(l, r) for l, r in on)), how)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    spread_by: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """:func:`keyed_join` whose left keys are each spread over ``policy.salts`` groups.

    ``left`` is the many side. Its rows get a salt derived from ``spread_by``, so a retried task draws
    the same one; ``right`` rows are repeated, once per salt. The salt is a column of its own and the
    keys are compared as they are, whatever their types.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(f"cannot salt a {how} join")
    if policy.salts <= 1:
        return keyed_join(left, right, on, how, null_safe)
    row_salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]), F.lit(policy.salts)).cast("int")
    spread = left.withColumn(SALT, row_salt)
    repeated = right.withColumn(SALT + "_r", F.explode(F.sequence(F.lit(0), F.lit(policy.salts - 1))))
    joined = keyed_join(spread, repeated, [*on, (SALT, SALT + "_r")], how, null_safe)
    return joined.drop(SALT, SALT + "_r")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after checking that ``keys`` identify its rows."""
    duplicate = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if duplicate:
        raise ValueError(f"{list(keys)} is not unique, for example {duplicate[0].asDict()}")
    return df
