"""A key that holds a third of all rows changes how joins run, not what they return."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.operators import aggregate as A
from matchday.operators.joins import join_result, join_sides
from matchday.operators.quantiles import bracketed_values, exact_percentiles, ranked_values
from matchday.operators.sampling import in_training_part, with_folds
from matchday.operators.skew import SkewPolicy, keyed_join, salted_join
from matchday.plans import tables as T
from matchday.plans.features import lag_feature_rows
from matchday.sources import star_schema

from .helpers import FOLDER, rows

EAGER = SkewPolicy(salts=8)


def skewed_games(inputs):
    """A third of the games moved to one team in one period."""
    third = F.pmod(F.xxhash64("game_id"), F.lit(3)) == 0
    return inputs.games.withColumns(
        {
            "home_team": F.when(third, F.lit("T3")).otherwise(F.col("home_team")),
            "season": F.when(third, F.lit(2000)).otherwise(F.col("season")),
            "week": F.when(third, F.lit(5)).otherwise(F.col("week")),
        }
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("kinds", [("int", "bigint"), ("bigint", "int"), ("smallint", "double"), ("string", "string"), ("decimal(9,0)", "int")])
def test_salted_equals_plain_for_every_type(spark, how, null_safe, kinds):
    key = F.when(F.col("id") % 3 == 0, F.lit(4)).when(F.col("id") % 7 > 0, F.col("id") % 20)
    left = spark.range(600).select("id", key.cast(kinds[0]).alias("k"))
    right = spark.range(12).select(F.when(F.col("id") > 0, F.col("id")).cast(kinds[1]).alias("r"), F.col("id").alias("v"))
    plain = keyed_join(left, right, [("k", "r")], how, null_safe)
    salted = salted_join(left, right, [("k", "r")], ["id"], how, null_safe, EAGER)
    assert rows(plain) == rows(salted) and plain.columns == salted.columns


def test_text_against_a_number_is_refused(spark):
    with pytest.raises(TypeError, match="cast one of them"):
        salted_join(spark.range(3), spark.createDataFrame([("1",)], "r string"), [("id", "r")], ["id"])


def test_sides_of_other_integer_widths(inputs):
    games = inputs.games.select("game_id", "home_team", "away_team", F.col("season").cast("int"), F.col("week").cast("int"))
    stats = inputs.team_stats.withColumns({"season": F.col("season").cast("bigint"), "week": F.col("week").cast("bigint")})
    plain = join_sides(games, inputs.team_stats, ["carries"])
    assert rows(plain) == rows(join_sides(games, stats, ["carries"], policy=EAGER).select(*plain.columns))


def test_no_jobs_while_a_plan_is_built(spark, inputs):
    fresh = type(inputs)(spark, FOLDER)
    spark.sparkContext.setJobGroup("building", "")
    try:
        for plan in (lag_feature_rows(fresh.games, fresh.team_stats, fresh.cfg), T.training_data(fresh.games, fresh.team_stats)):
            assert plan.columns
        # reading a file's schema is the only job
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_rows_are_spread(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    right = spark.range(6000).select(F.col("id").alias("r"), F.lit(1).alias("v")).union(spark.createDataFrame([(-1, 2)], "r long, v int"))
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def largest(joined):
            sizes = joined.where("k = -1").groupBy(F.spark_partition_id()).count()
            return max(r["count"] for r in sizes.collect())

        assert largest(keyed_join(df, right, [("k", "r")])) == 2000
        salted = salted_join(df, right, [("k", "r")], ["id"], policy=EAGER)
        assert largest(salted) < 1500
        assert salted.where("k = -1 AND v = 2").count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_two_sided_join(inputs):
    games = skewed_games(inputs).select("game_id", "season", "week", "home_team", "away_team")
    plain = join_sides(games, inputs.team_stats, ["carries", "sacks"])
    salted = join_sides(games, inputs.team_stats, ["carries", "sacks"], policy=EAGER)
    assert sorted(plain.columns) == sorted(salted.columns)
    assert rows(plain) == rows(salted.select(*plain.columns))


def test_result_join(inputs):
    sides = T.winners_by_side(skewed_games(inputs))
    plain = join_result(inputs.team_stats, sides)
    salted = join_result(inputs.team_stats, sides, EAGER)
    columns = ["recent_team", "season", "week", "winner", "carries", "game_id"]
    assert rows(plain.select(*columns)) == rows(salted.select(*columns))


def test_score_tables(inputs):
    games = inputs.games.where("season < 1997")
    third = F.pmod(F.xxhash64("game_id"), F.lit(3)) == 0
    games = games.withColumn("home_team", F.when(third, F.lit("T3")).otherwise(F.col("home_team")))
    policy = SkewPolicy(salts=4)
    scores = A.score_data(games, inputs.team_stats)
    assert rows(scores) == rows(A.score_data(games, inputs.team_stats, policy).select(*scores.columns))
    columns = ["kicking_points", "sacks"]
    plain = T.weekly_score_rows(games, inputs.team_stats, columns=columns, keep=["game_id"])
    salted = T.weekly_score_rows(games, inputs.team_stats, columns=columns, keep=["game_id"], policy=policy)
    assert rows(plain) == rows(salted)
    trained = T.training_data(games, inputs.team_stats, weight="n", keep=["game_id"])
    assert rows(trained) == rows(T.training_data(games, inputs.team_stats, weight="n", keep=["game_id"], policy=policy))


def test_percentiles_of_a_hot_group(spark):
    data = np.random.default_rng(7)
    values = np.round(data.normal(size=4000), 2)
    groups = np.where(np.arange(4000) % 3 == 0, "hot", data.integers(0, 40, 4000).astype(str))
    pairs = list(zip(groups.tolist(), values.tolist())) + [(None, 1.0), (None, 4.0), ("empty", None)]
    df = spark.createDataFrame(pairs, "g string, v double")
    found = {r["g"]: (r["p10"], r["p50"], r["p75"]) for r in exact_percentiles(df, ["g"], ["v"], [0.1, 0.5, 0.75]).collect()}
    assert "empty" not in found and found[None] == (1.3, 2.5, 3.25)
    for group in set(groups.tolist()):
        np.testing.assert_allclose(found[group], np.percentile(values[groups == group], [10, 50, 75]))


@pytest.mark.parametrize("accuracy", [4, 20, 100])
def test_brackets_hold_the_percentiles(spark, accuracy):
    data = np.random.default_rng(accuracy)
    groups = {"ties": data.integers(0, 3, 3000), "normal": data.normal(size=5001), "skewed": np.exp(data.normal(size=2999) * 3), "few": data.normal(size=7)}
    groups |= {f"n{n}": data.integers(0, 50, n) for n in range(1, 24)}
    pairs = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(pairs, "g string, v double").repartition(6)
    probabilities = [0.75, 0.0, 0.5, 0.1, 1.0]
    for r in exact_percentiles(df, ["g"], ["v"], probabilities, accuracy).collect():
        wanted = np.percentile(groups[r["g"]], [75, 0, 50, 10, 100])
        np.testing.assert_allclose([r["p75"], r["p00"], r["p50"], r["p10"], r["p100"]], wanted, rtol=1e-12)


def test_only_bracketed_values_move(spark):
    df = spark.range(200_000).select(F.lit("one").alias("g"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    inside = bracketed_values(df, ["g"], ["v"], [0.25, 0.5, 0.75], 1000)
    assert 0 < inside.count() < 3 * 200_000 * 6 / 1000
    assert "RangePartitioning" not in inside._jdf.queryExecution().executedPlan().toString()


def test_one_group_is_cut_into_slices(spark):
    df = spark.range(20000).select(F.lit("one").alias("g"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranked_values(df, ["g"], ["v"])
        tasks = ranked.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 3 and max(t["count"] for t in tasks) < 15000
        assert ranked.where("first <> value OR last <> value").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_folds_are_balanced_and_stable(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    folded = with_folds(df, "k", "y")
    sizes = folded.groupBy("y", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    assert rows(folded) == rows(with_folds(df.repartition(3), "k", "y"))


def test_folds_do_not_depend_on_the_buckets(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, 1).alias("y"))
    wanted = rows(with_folds(df, "k", "y"))
    assert len(wanted) == 5000
    # a label holds two thirds of the rows; its buckets are refined twice
    for most in (1, 40, 700):
        assert rows(with_folds(df, "k", "y", bucket_rows=most)) == wanted
    assert with_folds(df.limit(0), "k", "y").collect() == []


def test_split_share(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    assert abs(df.where(in_training_part(F.col("k"))).count() / 20000 - 0.7) < 0.02


def test_lines_of_a_hot_order(spark, tmp_path):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    third = F.pmod(F.xxhash64(*lines.columns), F.lit(3)) == 0
    lines.withColumn("l_orderkey", F.when(third, F.lit(7)).otherwise(F.col("l_orderkey"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{FOLDER}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    columns = ["recent_team", "season", "week", "carries", "sacks"]
    plain = star_schema.weekly_scores(spark, str(tmp_path)).select(*columns)
    salted = star_schema.weekly_scores(spark, str(tmp_path), EAGER).select(*columns)
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(plain) == rows(salted)
