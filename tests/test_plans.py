"""What the physical plans must look like."""

from pyspark.sql import functions as F

from matchday.operators.joins import join_sides, unpivot_sides
from matchday.operators.lag import lag_profiles
from matchday.plans import tables as T
from matchday.plans.features import lag_feature_rows


def executed(df) -> str:
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unpivot_scans_once(inputs):
    stored = inputs.spark.read.parquet(f"{inputs.folder}/orders.parquet").select(
        F.col("o_orderkey").alias("home_team"), F.col("o_custkey").alias("away_team"), F.lit(1).alias("season")
    )
    plan = planned(unpivot_sides(stored, ["season"]))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_trailing_window_needs_no_join_and_one_extra_shuffle(inputs):
    stats = inputs.spark.read.parquet(f"{inputs.folder}/lineitem.parquet").select(
        F.col("l_orderkey").alias("recent_team"), F.lit(2000).alias("season"), F.lit(3).alias("week"),
        F.col("l_quantity").alias("carries"),
    )
    plan = planned(lag_profiles(stats, inputs.cfg, {"avg_carries": "carries"}, ()))
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_both_sides_share_the_statistics(inputs):
    conf = inputs.spark.conf
    previous = conf.get("spark.sql.autoBroadcastJoinThreshold")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        games = inputs.games.select("game_id", "season", "week", "home_team", "away_team")
        plan = executed(join_sides(games, inputs.team_stats, ["carries"]))
    finally:
        conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "ReusedExchange" in plan
    # Both feeds of the statistics are scanned once.
    assert plan.count("lineitem.parquet") == 1


def test_training_rows_do_not_compute_kicking_points(inputs):
    plan = planned(T.training_data(inputs.games, inputs.team_stats))
    assert "sum(home_score" not in plan and "special_teams_tds" not in plan


def test_filter_reaches_the_statistics_side(inputs):
    df = lag_feature_rows(inputs.games, inputs.team_stats, inputs.cfg).where("season = 2000 AND week = 13")
    plan = planned(df)
    assert plan.count("= 2000") >= 2 and plan.count("= 13") >= 2


def test_no_cartesian_products(inputs):
    frames = [
        T.training_data(inputs.games, inputs.team_stats),
        inputs.team_results,
        inputs.base_model,
        lag_feature_rows(inputs.games, inputs.team_stats, inputs.cfg),
    ]
    for df in frames:
        plan = planned(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "PythonUDF" not in plan and "InPandas" not in plan


def test_density_moves_bins_and_agrees_with_the_sum_over_values(spark):
    import math
    import random

    from matchday.operators.describe import density

    draw = random.Random(5)
    values = [draw.gauss(0, 1) for _ in range(3000)] + [draw.gauss(60, 0.1) for _ in range(40)] + [None, 7.5, 7.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = [v for v in values if v is not None]
    mean = sum(known) / len(known)
    width = math.sqrt(sum((v - mean) ** 2 for v in known) / (len(known) - 1)) * len(known) ** -0.2
    found = {r["point"]: r for r in density(df, "v", 50).collect()}
    assert len(found) == 50
    for r in found.values():
        exact = sum(math.exp(-0.5 * ((r["x"] - v) / width) ** 2) for v in known) / (len(known) * width * math.sqrt(2 * math.pi))
        assert abs(r["density"] - exact) < 1e-11
    # a value range without spread has no density, no values have no grid
    assert {r["density"] for r in density(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 5).collect()} == {None}
    assert density(df.limit(0), "v", 5).count() == 0
