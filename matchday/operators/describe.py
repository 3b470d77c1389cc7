"""Descriptive statistics: summary, correlation, box, histogram and density numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions import scalars as S
from matchday.functions.projections import q
from matchday.operators.quantiles import exact_percentiles, melt, percentile_name
from matchday.workspace import materialise

# The columns the descriptive report looks at.
RUSHING_METRICS = ("carries", "rushing_yards", "rushing_tds", "yards_per_carry", "rush_td_efficiency")
QUARTILES = (0.25, 0.5, 0.75)


def with_rushing_ratios(stats: DataFrame) -> DataFrame:
    """Yards and touchdowns per carry; NULL without carries."""
    return stats.withColumns(
        {
            "yards_per_carry": S.ratio(q("rushing_yards"), q("carries")),
            "rush_td_efficiency": S.ratio(q("rushing_tds"), q("carries")),
        }
    )


def _same_group(keys: Sequence[str], prefix: str) -> Column:
    return reduce(and_, (q(k).eqNullSafe(q(prefix + k)) for k in [*keys, "metric"]))


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in [*keys, "metric"]})


def _stored(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The columns a report reads, written once: it reads them several times."""
    return materialise(df.select(*[q(c) for c in dict.fromkeys([*keys, *metrics])]), "described")


def describe(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per group and metric.

    Moments are one aggregate, which sums before it moves anything; of the values themselves only those
    next to a quartile move.
    """
    rows = _stored(df, keys, metrics)
    moments = melt(rows, keys, metrics).groupBy(*keys, "metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = _prefixed(exact_percentiles(rows, keys, metrics, QUARTILES), keys, "q_")
    names = [percentile_name(p) for p in QUARTILES]
    return moments.join(quartiles, _same_group(keys, "q_")).select(*keys, "metric", "count", "mean", "std", "min", *names, "max")


def describe_approximately(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], accuracy: int = 10_000
) -> DataFrame:
    """:func:`describe` in one pass; the rank of a quartile is off by at most ``1 / accuracy``."""
    sketch = F.percentile_approx("value", [float(p) for p in QUARTILES], accuracy)
    one_pass = melt(df, keys, metrics).groupBy(*keys, "metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        sketch.alias("p"),
        F.max("value").alias("max"),
    )
    quartiles = [F.col("p")[k].alias(percentile_name(p)) for k, p in enumerate(QUARTILES)]
    return one_pass.select(*keys, "metric", "count", "mean", "std", "min", *quartiles, "max")


def correlation(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Pearson matrix over pairwise-complete rows, as ``(metric_a, metric_b, corr)``.

    All pairs come from one aggregation. A constant column has no correlation (NULL).
    """
    def pearson(a: str, b: str) -> Column:
        x = F.when(q(b).isNotNull(), q(a).cast("double"))
        y = F.when(q(a).isNotNull(), q(b).cast("double"))
        return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))

    pairs = list(combinations_with_replacement(metrics, 2))
    wide = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        for left, right in {(a, b), (b, a)}:
            cells.append(
                F.struct(F.lit(left).alias("metric_a"), F.lit(right).alias("metric_b"), q(f"{a}|{b}").alias("corr"))
            )
    return wide.select(F.inline(F.array(*cells)))


def _boxes(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Every value with the quartiles and fences of its group."""
    rows = _stored(df, keys, metrics)
    quartiles = exact_percentiles(rows, keys, metrics, QUARTILES)
    spread = q("p75") - q("p25")
    fences = quartiles.select(
        "*", (q("p25") - 1.5 * spread).alias("low_fence"), (q("p75") + 1.5 * spread).alias("high_fence")
    )
    boxes = materialise(_prefixed(fences, keys, "b_"), "boxes")
    return melt(rows, keys, metrics).join(boxes, _same_group(keys, "b_"))


def box_stats(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and outlier count."""
    inside = q("value").between(q("low_fence"), q("high_fence"))
    return _boxes(df, keys, metrics).groupBy(*keys, "metric", "p25", "p50", "p75").agg(
        F.min(F.when(inside, q("value"))).alias("whisker_low"),
        F.max(F.when(inside, q("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The points a box plot draws beyond its whiskers, equal ones counted."""
    outside = ~q("value").between(q("low_fence"), q("high_fence"))
    return _boxes(df, keys, metrics).where(outside).groupBy(*keys, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, metric: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over the value range; the last bin is closed; empty bins count 0."""
    values = df.select(q(metric).cast("double").alias("value")).where("value IS NOT NULL")
    limits = values.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    width = (F.col("r.hi") - F.col("r.lo")) / bins
    place = F.floor((q("value") - F.col("r.lo")) / F.nullif(width, F.lit(0.0)))
    placed = values.withColumn("r", limits).select(
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    filled = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(q("id").cast("int").alias("bin_number")).withColumn("r", limits)
    return frame.join(filled, q("bin_number") == q("bin"), "left").select(
        q("bin_number").alias("bin"),
        (F.col("r.lo") + width * q("bin_number")).alias("bin_low"),
        (F.col("r.lo") + width * (q("bin_number") + 1)).alias("bin_high"),
        F.coalesce(q("n"), F.lit(0)).alias("count"),
    )


#: Terms of the expansion of a Gaussian around the middle of a bin that is half a bandwidth wide. The terms left out
#: add at most 3e-12 to the kernel of a value, which itself is between 0 and 1.
HERMITE_TERMS = 12


def _hermite_coefficients(terms: int) -> list[list[int]]:
    """Of each Hermite polynomial below ``terms``, the coefficients from the constant upwards."""
    found = [[1], [0, 2]]
    for k in range(1, terms - 1):
        shifted = [0, *[2 * c for c in found[k]]]
        below = found[k - 1] + [0] * (len(shifted) - len(found[k - 1]))
        found.append([s - 2 * k * b for s, b in zip(shifted, below, strict=True)])
    return found[:terms]


def density(df: DataFrame, metric: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over the value range.

    The bandwidth is the sample deviation times ``n ** (-1/5)``; where it is 0 or unknown the density is NULL. By
    a fast Gauss transform: values are summed to moments around the middle of their bin, half a bandwidth
    wide, before they move, and each bin, not each value, adds to the grid points. So the rows after the
    scan follow the range in bandwidths, not the number of distinct values. See HERMITE_TERMS for the error.
    """
    values = df.select(q(metric).cast("double").alias("value")).where("value IS NOT NULL")
    summary = values.agg(
        F.struct(
            F.count("value").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            (F.stddev_samp("value") * F.pow(F.count("value").cast("double"), F.lit(-0.2))).alias("h"),
        )
    ).scalar()
    width = F.nullif(F.col("r.h"), F.lit(0.0)) / 2
    scale = F.nullif(F.col("r.h"), F.lit(0.0)) * math.sqrt(2)
    bin_number = F.floor((q("value") - F.col("r.lo")) / width)
    placed = values.withColumn("r", summary).select("r", bin_number.alias("bin"), "value")
    middle = F.col("r.lo") + (q("bin") + 0.5) * width
    offset = (q("value") - middle) / scale
    moments = [(F.sum(F.pow(offset, F.lit(float(k)))) / math.factorial(k)).alias(f"m{k}") for k in range(HERMITE_TERMS)]
    bins = placed.groupBy("r", "bin").agg(*moments)
    # the sum over the Hermite polynomials, ordered by powers of the distance
    hermite = _hermite_coefficients(HERMITE_TERMS)
    powers = [
        reduce(add, [q(f"m{k}") * float(hermite[k][j]) for k in range(j, HERMITE_TERMS) if hermite[k][j]]).alias(f"a{j}")
        for j in range(HERMITE_TERMS)
    ]
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    spread = bins.select("r", middle.alias("middle"), *powers).select("*", grid)
    at = F.col("r.lo") + (F.col("r.hi") - F.col("r.lo")) * q("point") / (points - 1)
    spread = spread.select("*", at.alias("x"), ((at - q("middle")) / scale).alias("t"))
    polynomial = q(f"a{HERMITE_TERMS - 1}")
    for j in reversed(range(HERMITE_TERMS - 1)):
        polynomial = polynomial * q("t") + q(f"a{j}")
    weight = F.sum(polynomial * F.exp(-q("t") * q("t")))
    norm = F.col("r.n") * F.nullif(F.col("r.h"), F.lit(0.0)) * math.sqrt(2 * math.pi)
    return spread.groupBy("point", "x", norm.alias("norm")).agg(weight.alias("weight")).select(
        "point", "x", (q("weight") / q("norm")).alias("density")
    )
