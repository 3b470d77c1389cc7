"""Calendar windows, ordering and the side-by-side unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.config import LAG_AVERAGES, LAG_FEATURE_SOURCE, LAG_TOTALS, SIDE_FEATURES
from matchday.functions.predicates import lag_rows
from matchday.operators import aggregate as A
from matchday.operators.describe import RUSHING_METRICS, correlation, with_rushing_ratios
from matchday.operators.lag import expanding_totals, trailing_profiles
from matchday.functions.projections import q
from matchday.plans.tables import winners_by_side
from matchday.plans.training import top
from matchday.registry import Inputs, query
from matchday.registry.oracle import CURRENT, TARGET, lag_predicate, table, with_tables

LAG_FEATURE_NAME = {source: name for name, source in LAG_FEATURE_SOURCE.items()}


_FRAMED = ", ".join(
    [f"avg({src}) OVER before AS {LAG_FEATURE_NAME[out]}" for out, src in LAG_AVERAGES.items() if out in LAG_FEATURE_NAME]
    + [f"sum({m}) OVER before AS {LAG_FEATURE_NAME[m]}" for m in LAG_TOTALS if m in LAG_FEATURE_NAME]
)
_MEASURED = sorted({*LAG_AVERAGES.values(), *LAG_TOTALS})
_TRAILING = f"""
SELECT recent_team, season, week, {", ".join(SIDE_FEATURES)}
FROM (
    SELECT recent_team, season, week, count(fact) OVER before AS rows, {_FRAMED}
    FROM (
        SELECT recent_team, 0 AS lane, season * 18 + week AS ordinal, 1 AS fact, NULL AS season, NULL AS week, {", ".join(_MEASURED)}
        FROM int_team_stats WHERE week BETWEEN 1 AND 18
        UNION ALL
        SELECT recent_team, season, week, 1, NULL, NULL, {", ".join(_MEASURED)} FROM int_team_stats WHERE week BETWEEN 16 AND 22
        UNION ALL
        SELECT recent_team, CASE WHEN week <= 18 THEN 0 ELSE season END, CASE WHEN week <= 18 THEN season * 18 + week ELSE week END,
               NULL, season, week, {", ".join("NULL" for _ in _MEASURED)}
        FROM (SELECT DISTINCT recent_team FROM int_team_stats),
             (SELECT CAST(unnest(range((SELECT min(season) FROM int_team_stats), (SELECT max(season) + 2 FROM int_team_stats))) AS INTEGER) AS season),
             (SELECT CAST(unnest(range(1, 23)) AS INTEGER) AS week)
    ) AS placed
    WINDOW before AS (PARTITION BY recent_team, lane ORDER BY ordinal RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING)
) AS framed
WHERE season IS NOT NULL AND rows > 0
"""


@query("win_trailing", with_tables(_TRAILING, "int_team_stats"))
def win_trailing(i: Inputs) -> DataFrame:
    profiles = trailing_profiles(i.team_stats, i.cfg)
    return profiles.select("recent_team", "season", "week", *[q(LAG_FEATURE_SOURCE[m]).alias(m) for m in SIDE_FEATURES])


_EXPANDING = """
SELECT recent_team, season, week,
       CAST(coalesce(sum(rows) OVER earlier, 0) AS BIGINT) AS rows_before,
       sum(points) OVER earlier AS points_before
FROM (SELECT recent_team, season, week, count(*) AS rows, sum(touchdown_points) AS points
      FROM int_team_stats GROUP BY recent_team, season, week) AS period
WINDOW earlier AS (PARTITION BY recent_team ORDER BY season, week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


@query("win_expanding", with_tables(_EXPANDING, "int_team_stats"))
def win_expanding(i: Inputs) -> DataFrame:
    return expanding_totals(i.team_stats, ["recent_team"], {"points": "touchdown_points"})


_RANKED = """
SELECT feature, importance FROM (
""" + " UNION ALL ".join(
    f"SELECT '{a}~{b}' AS feature, round(abs(corr({a}, {b})), 6) AS importance FROM rushing"
    for n, a in enumerate(RUSHING_METRICS)
    for b in RUSHING_METRICS[n + 1 :]
) + """) AS ranked ORDER BY importance DESC, feature LIMIT 10
"""


@query("srt_topk", with_tables(_RANKED, "rushing"))
def srt_topk(i: Inputs) -> DataFrame:
    pairs = correlation(with_rushing_ratios(i.team_results), RUSHING_METRICS)
    rank = {m: n for n, m in enumerate(RUSHING_METRICS)}
    order = F.create_map(*[F.lit(v) for pair in rank.items() for v in pair])
    ranked = pairs.where(order[q("metric_a")] < order[q("metric_b")]).select(
        F.concat_ws("~", "metric_a", "metric_b").alias("feature"),
        F.round(F.abs("corr"), 6).alias("importance"),
    )
    return top(ranked, 10)


@query("set_unpivot_sides", table("sides"))
def set_unpivot_sides(i: Inputs) -> DataFrame:
    return winners_by_side(i.games)


_WINDOWED = f"SELECT team, kicking_points FROM kicking_stats WHERE {lag_predicate(CURRENT, TARGET)}"


@query("set_unpivot_filtered", with_tables(_WINDOWED, "kicking_stats"))
def set_unpivot_filtered(i: Inputs) -> DataFrame:
    window = lag_rows(i.cfg)
    scores = A.score_data(i.games.where(window), i.team_stats.where(window))
    return A.kicking_stats(scores).select("team", "kicking_points")
