"""NULL, key and calendar rules on literal frames, with the expected rows written by hand."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from matchday.config import LAG_AVERAGES, LAG_TOTALS, MEASURES, SeasonConfig, WEEKLY_MEASURES
from matchday.functions import predicates as P
from matchday.functions import projections as J
from matchday.functions import scalars as S
from matchday.functions.calendar import lag_calendar, lag_periods, lag_targets, week_number, week_of_season
from matchday.operators import aggregate as A
from matchday.operators import describe as D
from matchday.operators.joins import join_sides, unseen_periods
from matchday.operators.lag import lag_profile_of_target, lag_profiles, trailing_profiles
from matchday.operators.skew import require_unique
from matchday.plans import tables as T
from matchday.sources.feeds import scan

from .helpers import rows

CFG = SeasonConfig()


def periods(spark, *values):
    return spark.createDataFrame(list(values), "season int, week int")


def test_past_row_without_week_is_training_data(spark):
    df = periods(spark, (1999, None), (2000, None), (2000, 12), (2000, 13), (2001, 1))
    assert rows(df.where(P.training_rows(CFG))) == [(1999, None), (2000, 12)]


def test_week_bound_of_schedule_holds_in_every_season(spark):
    df = periods(spark, (1999, 13), (1999, 14), (2000, 13), (2000, 14), (2001, 1))
    assert rows(df.where(P.schedule_rows(CFG))) == [(1999, 13), (2000, 13)]
    kept = rows(df.where(P.schedule_rows(CFG, current_season_only=True)))
    assert kept == [(1999, 13), (1999, 14), (2000, 13)]


def test_first_week_trains_on_the_previous_season(spark):
    df = periods(spark, (1998, 5), (1999, 5), (2000, 0))
    assert rows(df.where(P.walk_forward_rows(CFG.for_week(1)))) == [(1999, 5)]
    assert rows(df.where(P.walk_forward_rows(CFG.for_week(2)))) == [(1998, 5), (1999, 5), (2000, 0)]


@pytest.mark.parametrize(
    "week, expected",
    [
        (1, {(1999, 16), (1999, 17), (1999, 18)}),
        (2, {(1999, 17), (1999, 18), (2000, 1)}),
        (3, {(1999, 18), (2000, 1), (2000, 2)}),
        (4, {(2000, 1), (2000, 2), (2000, 3)}),
        (19, {(2000, 16), (2000, 17), (2000, 18)}),
        (22, {(2000, 19), (2000, 20), (2000, 21)}),
    ],
)
def test_lag_window(spark, week, expected):
    assert set(lag_periods(2000, week)) == expected
    calendar = lag_calendar(periods(spark, (2000, week)))
    assert {(r["season"], r["week"]) for r in calendar.collect()} == expected


@pytest.mark.parametrize("lag", [1, 3, 5])
def test_window_reads_the_same_from_both_ends(spark, lag):
    every = [(s, w) for s in (1999, 2000, 2001) for w in range(1, 23)]
    back = {(t, p) for t in every for p in lag_periods(*t, lag=lag) if p in every}
    targets = lag_targets(F.col("season"), F.col("week"), lag)
    fed = periods(spark, *every).select("season", "week", F.explode(targets).alias("t")).where("t IS NOT NULL")
    ahead = {((r["t"]["season"], r["t"]["week"]), (r["season"], r["week"])) for r in fed.collect()}
    assert {(t, p) for t, p in ahead if t in every} == back


def test_all_targets_equal_the_single_target_form(inputs):
    profiles = lag_profiles(inputs.team_stats, CFG)
    for week in (1, 2, 3, 4, 13, 19, 22):
        one = lag_profile_of_target(inputs.team_stats, replace(CFG, target_week=week))
        same = profiles.where((F.col("season") == 2000) & (F.col("week") == week)).select(*one.columns)
        assert rows(one) == rows(same)


def test_week_of_season_counts_started_weeks(spark):
    start = date(2000, 1, 1)
    days = [date(1999, 12, 20), start, date(2000, 1, 2), date(2000, 1, 8), date(2000, 1, 9)]
    assert [week_number(d, start) for d in days] == [1, 1, 1, 1, 2]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(week_of_season(F.col("d"), start)).collect()] == [1, 1, 1, 1, 2]


def test_regular_code_is_case_sensitive(spark):
    df = spark.createDataFrame([("REG",), ("reg",), ("SB",), (None,)], "t string")
    as_written = df.select(S.game_type_num(F.col("t"), "reg")).collect()
    assert [r[0] for r in as_written] == [1, 0, 1, 1]
    assert [r[0] for r in df.select(S.game_type_num(F.col("t"), "REG")).collect()] == [0, 1, 1, 1]


def test_recode_and_its_older_form(spark):
    df = spark.createDataFrame([("REG",), ("WC",), ("XX",), (None,)], "t string")
    assert [r[0] for r in df.select(S.season_type(F.col("t"))).collect()] == ["REG", "POST", None, None]
    assert [r[0] for r in df.select(S.season_type_else_post(F.col("t"))).collect()] == ["REG", "POST", "POST", "POST"]


def test_winner_keeps_the_raw_code(spark, inputs):
    base = inputs.feed_games.limit(0)
    games = spark.createDataFrame(
        [("g1", "OAK", "T5", 20.0, 10.0), ("g2", None, "T5", 20.0, 10.0), ("g3", "T4", "T5", 7.0, 7.0)],
        "game_id string, home_team string, away_team string, home_score double, away_score double",
    ).withColumns({"season": F.lit(2000), "week": F.lit(1), "game_type": F.lit("REG")})
    clean = T.clean_schedule(base.unionByName(games, allowMissingColumns=True))
    assert rows(clean.select("game_id", "home_team", "winner", "outcome")) == [
        ("g1", "LV", "OAK", 1), ("g2", "LV", None, 1), ("g3", "T4", "T5", 0),
    ]
    results = T.winners_by_side(clean).select("game_id", "recent_team", S.win_or_loss(F.col("winner"), F.col("recent_team")))
    assert rows(results)[:2] == [("g1", "LV", "loss"), ("g1", "T5", "loss")]


def line(spark, *values):
    schema = "recent_team string, season int, season_type string, week int, carries double, rushing_tds double"
    df = spark.createDataFrame(list(values), schema)
    rest = [m for m in MEASURES if m not in ("carries", "rushing_tds")]
    return df.withColumns({m: F.lit(None).cast("double") for m in rest})


def test_filled_sums_keep_missing_keys_as_zero(spark):
    df = line(spark, (None, 2000, "REG", 1, None, 1.0), (None, 2000, "REG", 1, 2.0, None), ("A", 2000, None, 1, 1.0, 1.0))
    out = A.team_week_filled(df).select("recent_team", "season_type", "carries", "rushing_tds", "targets")
    assert rows(out) == [("0", "REG", 2.0, 1.0, 0.0), ("A", "0", 1.0, 1.0, 0.0)]


def test_plain_sums_keep_null(spark):
    df = line(spark, (None, 2000, "REG", 1, None, 1.0), ("A", 2000, None, 1, None, 1.0))
    out = A.team_week(df).select("recent_team", "season_type", "carries", "touchdown_points")
    assert rows(out) == [(None, "REG", None, None), ("A", None, None, None)]


def test_profile_skips_nulls_and_missing_keys(spark):
    df = spark.createDataFrame(
        [("A", 1.0, None, 5.0), ("A", 2.0, None, 7.0), ("A", 9.0, None, None), (None, 1.0, 1.0, 1.0), ("B", None, 4.0, None)],
        "team string, a double, b double, c double",
    )
    out = A.profile(df, ["team"], {"a": "median", "b": "sum", "c": "mean"})
    assert rows(out) == [("A", 2.0, 0.0, 6.0), ("B", None, 4.0, None)]


def test_ratio_without_carries_is_null(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(S.ratio(F.col("a"), F.col("b"))).collect()] == [5.0, None, None]


def test_null_keys_match_only_on_request(spark):
    games = spark.createDataFrame([("g", None, "A", 2000, 1)], "game_id string, home_team string, away_team string, season int, week int")
    stats = spark.createDataFrame([(None, 2000, 1, 3.0), ("A", 2000, 1, 4.0)], "recent_team string, season int, week int, v double")
    plain = join_sides(games, stats, ["v"])
    safe = join_sides(games, stats, ["v"], null_safe=True)
    assert rows(plain.select("v_home", "v_away")) == [(None, 4.0)]
    assert rows(safe.select("v_home", "v_away")) == [(3.0, 4.0)]


def test_unseen_periods_treats_missing_as_a_period(spark):
    new = periods(spark, (2000, 1), (2000, 2), (None, 1), (2000, None))
    assert rows(unseen_periods(new, periods(spark, (2000, 1), (None, 1)))) == [(2000, None), (2000, 2)]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    found = {(r["metric_a"], r["metric_b"]): r["corr"] for r in D.correlation(df, ["a", "b"]).collect()}
    assert found[("a", "b")] is None and found[("b", "b")] is None
    assert found[("a", "a")] == pytest.approx(1.0)


def test_describe_of_one_row_has_no_deviation(spark):
    df = spark.createDataFrame([("x", 3.0), ("y", None)], "g string, v double")
    out = D.describe(df, ["g"], ["v"]).collect()
    assert [tuple(r) for r in out] == [("x", "v", 1, 3.0, None, 3.0, 3.0, 3.0, 3.0, 3.0)]


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    counts = {r["bin"]: r["count"] for r in D.histogram(df, "v", 4).collect()}
    assert counts == {0: 2, 1: 0, 2: 0, 3: 0}


def test_scan_errors_are_raised(spark):
    periods(spark, (2000, 1)).createOrReplaceTempView("scan_periods")
    with pytest.raises(AnalysisException):
        scan(spark, "scan_periods", "2024").collect()
    with pytest.raises(AnalysisException):
        scan(spark, "no_such_table")


def test_strict_drop(spark):
    df = periods(spark, (2000, 1))
    assert J.drop_columns(df, ["week", "absent"]).columns == ["season"]
    with pytest.raises(ValueError):
        J.drop_columns(df, ["absent"], strict=True)


def test_reindex_keeps_nulls(spark):
    df = spark.createDataFrame([(None, 2)], "a int, b int")
    assert rows(J.reindex(df, ["a", "c"])) == [(None, 0)]


def test_require_unique(spark):
    with pytest.raises(ValueError):
        require_unique(periods(spark, (2000, 1), (2000, 1)), ["season", "week"])


def test_weighted_rows_expand_to_the_repeated_ones(inputs):
    weighted = T.training_data(inputs.games, inputs.team_stats, weight="n", keep=["game_id"])
    repeated = T.training_data(inputs.games, inputs.team_stats, keep=["game_id"])
    counts = repeated.groupBy("game_id").count()
    sums = weighted.groupBy("game_id").agg(F.sum("n").alias("count"))
    assert rows(counts) == rows(sums)


def test_copies_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "COPY_BLOCK", 3)
    df = spark.createDataFrame([("a", 7, 1), ("b", 2, 3), ("c", 1, None)], "k string, __repeat_home long, __repeat_away long")
    assert rows(T._repeated(df, ["k"], None).groupBy("k").count()) == [("a", 7), ("b", 6), ("c", 1)]


def test_short_weekly_table_drops_helpers(inputs):
    short = J.with_derived_measures(A.team_week_filled(inputs.feed_weekly), keep_parts=False)
    assert "touchdowns" not in short.columns and len(short.columns) == 4 + len(WEEKLY_MEASURES) - 2 + 3


def test_range_frames_equal_the_expanded_windows(spark):
    measures = list(dict.fromkeys([*LAG_AVERAGES.values(), *LAG_TOTALS]))
    periods = [(1999, w) for w in (1, 2, 16, 17, 18, 19, 20, 21, 22)] + [(2000, w) for w in (1, 2, 4, 18, 22)] + [(2001, 3)]
    values = [(team, s, w, *[float((s + w * (n + 1)) % 7) if (w + n) % 5 else None for n in range(len(measures))]) for team in ("A", None) for s, w in periods]
    values += [("B", 2000, None, *[1.0] * len(measures)), ("C", None, 3, *[1.0] * len(measures)), ("A", 2000, 2, *[5.0] * len(measures))]
    stats = spark.createDataFrame(values, "recent_team string, season int, week int, " + ", ".join(f"{m} double" for m in measures))
    columns = ["recent_team", "season", "week", *LAG_AVERAGES, *LAG_TOTALS]
    framed = trailing_profiles(stats, CFG)
    known = stats.where("season IS NOT NULL AND week IS NOT NULL")
    assert rows(framed.select(*columns)) == rows(lag_profiles(known, CFG).select(*columns))
    plan = framed._jdf.queryExecution().executedPlan().toString()
    assert "Window " in plan and "RangeFrame" in plan
    assert trailing_profiles(stats.limit(0), CFG).collect() == []
