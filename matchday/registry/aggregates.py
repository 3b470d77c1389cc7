"""Aggregations and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.projections import q
from matchday.operators import aggregate as A
from matchday.operators import describe as D
from matchday.operators.joins import distinct_periods
from matchday.operators.lag import kicking_average_of_target, kicking_averages, lag_profile_of_target, lag_profiles
from matchday.registry import Inputs, query
from matchday.registry.oracle import CURRENT, TARGET, table, with_tables
from matchday.registry.storage import ODDS
from matchday.sources.feeds import row_count

METRICS = D.RUSHING_METRICS
DIGITS = 6


@query("agg_team_week", table("weekly_sums"))
def agg_team_week(i: Inputs) -> DataFrame:
    return A.team_week_filled(i.feed_weekly)


@query("agg_team_week_sql", table("int_team_stats"))
def agg_team_week_sql(i: Inputs) -> DataFrame:
    return i.team_stats


@query("agg_score_data", table("score_data"))
def agg_score_data(i: Inputs) -> DataFrame:
    return A.score_data(i.games, i.team_stats)


@query("agg_kicking_avg", table("kicking_avg"))
def agg_kicking_avg(i: Inputs) -> DataFrame:
    return kicking_averages(A.kicking_stats(A.score_data(i.games, i.team_stats)), i.cfg)


_ONE_KICKING = f"SELECT team, avg_kicking_points FROM kicking_avg WHERE season = {CURRENT} AND week = {TARGET}"


@query("agg_kicking_avg_target", with_tables(_ONE_KICKING, "kicking_avg"))
def agg_kicking_avg_target(i: Inputs) -> DataFrame:
    return kicking_average_of_target(A.kicking_stats(A.score_data(i.games, i.team_stats)), i.cfg)


@query("agg_lag", table("lag_profile"))
def agg_lag(i: Inputs) -> DataFrame:
    return lag_profiles(i.team_stats, i.cfg)


_ONE_PROFILE = f"SELECT * EXCLUDE (season, week) FROM lag_profile WHERE season = {CURRENT} AND week = {TARGET}"


@query("agg_lag_target", with_tables(_ONE_PROFILE, "lag_profile"))
def agg_lag_target(i: Inputs) -> DataFrame:
    return lag_profile_of_target(i.team_stats, i.cfg)


@query("agg_distinct_periods", with_tables("SELECT DISTINCT season, week FROM stg_weekly_scores", "stg_weekly_scores"))
def agg_distinct_periods(i: Inputs) -> DataFrame:
    return distinct_periods(i.feed_weekly)


_AUDITED = [*ODDS, "home_score", "away_score", "spread_line", "temp"]
_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS null_count FROM int_schedules WHERE {c} IS NULL" for c in _AUDITED
)


@query("agg_null_counts", with_tables(f"SELECT * FROM ({_NULLS}) AS n WHERE null_count > 0", "int_schedules"))
def agg_null_counts(i: Inputs) -> DataFrame:
    return A.null_counts(i.games, _AUDITED)


def _rounded(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: F.round(q(n), DIGITS) for n in names})


def _per_metric(body: str) -> str:
    """``body`` once per metric, with ``{m}`` as the column."""
    return " UNION ALL ".join(body.replace("{m}", m) for m in METRICS)


_DESCRIBED = _per_metric(
    f"""
    SELECT result, '{{m}}' AS metric, count({{m}}) AS "count", round(avg({{m}}), {DIGITS}) AS mean,
           round(stddev_samp({{m}}), {DIGITS}) AS std, round(min({{m}}), {DIGITS}) AS "min",
           round(quantile_cont({{m}}, 0.25), {DIGITS}) AS p25, round(quantile_cont({{m}}, 0.5), {DIGITS}) AS p50,
           round(quantile_cont({{m}}, 0.75), {DIGITS}) AS p75, round(max({{m}}), {DIGITS}) AS "max"
    FROM rushing GROUP BY result"""
)


@query("agg_describe", with_tables(_DESCRIBED, "rushing"))
def agg_describe(i: Inputs) -> DataFrame:
    summary = D.describe(D.with_rushing_ratios(i.team_results), ["result"], METRICS)
    return _rounded(summary, ["mean", "std", "min", "p25", "p50", "p75", "max"])


_CORRELATED = " UNION ALL ".join(
    f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, round(corr({a}, {b}), {DIGITS}) AS corr FROM rushing"
    for a in METRICS
    for b in METRICS
)


@query("agg_corr", with_tables(_CORRELATED, "rushing"))
def agg_corr(i: Inputs) -> DataFrame:
    return _rounded(D.correlation(D.with_rushing_ratios(i.team_results), METRICS), ["corr"])


_FENCES = """
SELECT result, quantile_cont(yards_per_carry, 0.25) AS p25, quantile_cont(yards_per_carry, 0.5) AS p50,
       quantile_cont(yards_per_carry, 0.75) AS p75
FROM rushing GROUP BY result
"""
_BOXED = f"""
SELECT r.result, 'yards_per_carry' AS metric, round(p25, {DIGITS}) AS p25, round(p50, {DIGITS}) AS p50,
       round(p75, {DIGITS}) AS p75,
       round(min(yards_per_carry) FILTER (yards_per_carry BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)), {DIGITS}) AS whisker_low,
       round(max(yards_per_carry) FILTER (yards_per_carry BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)), {DIGITS}) AS whisker_high,
       count(yards_per_carry) FILTER (yards_per_carry NOT BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)) AS outliers
FROM rushing AS r JOIN ({_FENCES}) AS f ON r.result = f.result
GROUP BY r.result, p25, p50, p75
"""
_OUTLIERS = f"""
SELECT r.result, 'yards_per_carry' AS metric, round(yards_per_carry, {DIGITS}) AS value, count(*) AS n
FROM rushing AS r JOIN ({_FENCES}) AS f ON r.result = f.result
WHERE yards_per_carry NOT BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)
GROUP BY r.result, yards_per_carry
"""


@query("agg_box_stats", with_tables(_BOXED, "rushing"))
def agg_box_stats(i: Inputs) -> DataFrame:
    boxes = D.box_stats(D.with_rushing_ratios(i.team_results), ["result"], ["yards_per_carry"])
    return _rounded(boxes, ["p25", "p50", "p75", "whisker_low", "whisker_high"])


@query("agg_box_outliers", with_tables(_OUTLIERS, "rushing"))
def agg_box_outliers(i: Inputs) -> DataFrame:
    points = D.box_outliers(D.with_rushing_ratios(i.team_results), ["result"], ["yards_per_carry"])
    return _rounded(points, ["value"])


_HISTOGRAM = """
SELECT CAST(b.bin AS INTEGER) AS bin, lo + width * b.bin AS bin_low, lo + width * (b.bin + 1) AS bin_high,
       count(v.place) AS "count"
FROM (SELECT min(carries) AS lo, (max(carries) - min(carries)) / 20 AS width FROM rushing) AS r
CROSS JOIN (SELECT unnest(range(0, 20)) AS bin) AS b
LEFT JOIN (SELECT least(coalesce(floor((carries - lo) / nullif(width, 0)), 0), 19) AS place
           FROM rushing, (SELECT min(carries) AS lo, (max(carries) - min(carries)) / 20 AS width FROM rushing) AS w
           WHERE carries IS NOT NULL) AS v ON v.place = b.bin
GROUP BY b.bin, lo, width
"""


@query("agg_histogram", with_tables(_HISTOGRAM, "rushing"))
def agg_histogram(i: Inputs) -> DataFrame:
    return D.histogram(i.team_results, "carries", 20)


_DENSITY = """
SELECT CAST(p.point AS INTEGER) AS point, round(lo + (hi - lo) * p.point / 199, 6) AS x,
       round(sum(v.n * exp(-0.5 * ((lo + (hi - lo) * p.point / 199 - v.value) / h) ^ 2)) / (s.n * h * sqrt(2 * pi())), 9) AS density
FROM (SELECT count(carries) AS n, min(carries) AS lo, max(carries) AS hi,
             stddev_samp(carries) * CAST(count(carries) AS DOUBLE) ^ (-0.2) AS h FROM rushing) AS s
CROSS JOIN (SELECT carries AS value, count(*) AS n FROM rushing WHERE carries IS NOT NULL GROUP BY carries) AS v
CROSS JOIN (SELECT CAST(unnest(range(0, 200)) AS DOUBLE) AS point) AS p
GROUP BY p.point, lo, hi, h, s.n
"""


@query("agg_kde", with_tables(_DENSITY, "rushing"))
def agg_kde(i: Inputs) -> DataFrame:
    curve = D.density(i.team_results, "carries", 200)
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query("agg_row_count", with_tables("SELECT count(*) AS row_count FROM int_schedules", "int_schedules"))
def agg_row_count(i: Inputs) -> DataFrame:
    return row_count(i.games)
