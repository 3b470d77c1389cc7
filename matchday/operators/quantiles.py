"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.projections import q
from matchday.workspace import materialise


def melt(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``(keys, metric, value)`` with one row per non-NULL value."""
    cells = [F.struct(F.lit(m).alias("metric"), q(m).cast("double").alias("value")) for m in metrics]
    long = df.select(*[q(k) for k in keys], F.explode(F.array(*cells)).alias("cell"))
    return long.select(*[q(k) for k in keys], "cell.metric", "cell.value").where("value IS NOT NULL")


def ranked_values(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Distinct values with the ranks they cover: ``(keys, metric, value, n, first, last, total, mean)``.

    Equal values are counted first. Spark then range-partitions the distinct ones, so that even a
    single hot group is cut into slices; the slices are written with their number, which fixes the
    cut. The rank of a value is its position in its slice plus the size of the slices before it.
    Ranks start at 0.
    """
    group = [*keys, "metric"]
    counts = melt(df, keys, metrics).groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    cut = counts.repartitionByRange(*[q(g) for g in group], q("value"))
    cut = materialise(cut.withColumn("slice", F.spark_partition_id()), "quantiles")

    of_group = Window.partitionBy(*group)
    sizes = cut.groupBy(*group, "slice").agg(
        F.sum("n").alias("rows"), F.sum(q("n") * q("value")).alias("mass")
    )
    offsets = sizes.select(
        *[q(c).alias(f"o_{c}") for c in [*group, "slice"]],
        (F.sum("rows").over(of_group.orderBy("slice")) - q("rows")).alias("before"),
        F.sum("rows").over(of_group).alias("total"),
        (F.sum("mass").over(of_group) / F.sum("rows").over(of_group)).alias("mean"),
    )
    same = reduce(and_, (q(c).eqNullSafe(q(f"o_{c}")) for c in [*group, "slice"]))
    in_slice = Window.partitionBy(*group, "slice").orderBy("value")
    last = q("before") + F.sum("n").over(in_slice) - 1
    ranked = cut.join(offsets, same).select(*group, "value", "n", "total", "mean", last.alias("last"))
    return ranked.withColumn("first", q("last") - q("n") + 1)


def percentile_name(p: float) -> str:
    return f"p{round(p * 100):02d}"


def _position(p: float) -> Column:
    return (q("total") - 1) * F.lit(float(p))


def _covers(rank: Column) -> Column:
    return (q("first") <= rank) & (rank <= q("last"))


def percentile_columns(probabilities: Sequence[float]) -> list[Column]:
    """Aggregates over ranked values that yield linearly interpolated percentiles."""
    picked = []
    for p in probabilities:
        position = _position(p)
        at_low = F.max(F.when(_covers(F.floor(position)), q("value")))
        at_high = F.max(F.when(_covers(F.ceil(position)), q("value")))
        share = F.max(position - F.floor(position))
        picked.append((at_low + (at_high - at_low) * share).alias(percentile_name(p)))
    return picked


def percentiles_of_ranked(ranked: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One column per probability, from the few ranked values that the percentiles fall on."""
    ranks = [edge(_position(p)) for p in probabilities for edge in (F.floor, F.ceil)]
    needed = reduce(or_, (_covers(r) for r in ranks))
    return ranked.where(needed).groupBy(*keys, "metric").agg(*percentile_columns(probabilities))


#: One over the rank error of the sketch, as a share of a group. Groups of up to four times as many values move whole.
SKETCH = 2000


def _brackets(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], probabilities: Sequence[float], accuracy: int) -> DataFrame:
    """``(keys, metric, total, low, high)``: arrays of values between which the ranks of the percentiles lie for certain.

    The sketch is asked for ranks two errors below and above. In a group of more than four times
    ``accuracy`` values that leaves room for the ranks next to a percentile; a smaller one is one bracket.
    """
    below = [max(0.0, p - 2 / accuracy) for p in probabilities]
    above = [min(1.0, p + 2 / accuracy) for p in probabilities]
    bounds = melt(df, keys, metrics).groupBy(*keys, "metric").agg(
        F.count("value").alias("total"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.percentile_approx("value", [*below, *above], accuracy).alias("at"),
    )
    whole = q("total") <= 4 * accuracy
    n = len(probabilities)
    low = F.when(whole, F.array(q("least"))).otherwise(F.slice("at", 1, n))
    high = F.when(whole, F.array(q("most"))).otherwise(F.slice("at", n + 1, n))
    return bounds.select(*keys, "metric", "total", low.alias("low"), high.alias("high"))


def bracketed_values(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], probabilities: Sequence[float], accuracy: int = SKETCH
) -> DataFrame:
    """Distinct values around the percentiles with the ranks they cover: ``(keys, metric, value, total, first, last)``.

    A sketch brackets the wanted ranks. A second pass counts: equal values inside a bracket become one
    row, and all values between two brackets become one row for each task, which stands before the
    upper one. So little more than the brackets moves, a few thousandths of a large group. ``df`` is read twice.
    """
    group = [*keys, "metric"]
    wanted = _brackets(df, keys, metrics, sorted(set(probabilities)), accuracy).withColumnsRenamed({c: f"w_{c}" for c in group})
    same = reduce(and_, (q(c).eqNullSafe(q(f"w_{c}")) for c in group))

    def place(value: Column, inside: int) -> Column:
        return F.struct(value.alias("value"), F.lit(inside).alias("inside"))

    def of_bracket(k: int) -> Column:
        low, high = F.get("low", F.lit(k)), F.get("high", F.lit(k))
        return F.when(q("value") <= high, F.when(q("value") >= low, place(q("value"), 1)).otherwise(place(low, 0)))

    at = F.coalesce(*[of_bracket(k) for k in range(len(set(probabilities)))])
    placed = melt(df, keys, metrics).join(wanted, same).select(*group, "total", at.alias("at"))
    counts = placed.where("at IS NOT NULL").groupBy(*group, "total", "at").agg(F.count(F.lit(1)).alias("n"))
    last = F.sum("n").over(Window.partitionBy(*group).orderBy("at")) - 1
    ranked = counts.select(*group, "total", "at.value", "at.inside", (last - q("n") + 1).alias("first"), last.alias("last"))
    return ranked.where("inside = 1").drop("inside")


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], probabilities: Sequence[float], accuracy: int = SKETCH
) -> DataFrame:
    """Exact percentiles of ``metrics`` per group, as ``(keys, metric, p25, ...)``. ``df`` is read twice."""
    return percentiles_of_ranked(bracketed_values(df, keys, metrics, probabilities, accuracy), keys, probabilities)
