"""Sources and sinks. A sink query writes to the shared folder and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.config import GAME_FEATURES, SIDE_FEATURES
from matchday.functions.projections import q
from matchday.operators.aggregate import null_counts
from matchday.plans.backtest import favourite_baseline
from matchday.plans.features import INPUT_COLUMNS, lag_feature_rows
from matchday.plans.template import target_week_query
from matchday.plans.training import ForestSettings, fit_forest, predict, split_features
from matchday.registry import Inputs, query
from matchday.registry.oracle import CURRENT, CUTOFF, TARGET, columns, table, with_tables
from matchday.sources import feeds, sinks
from matchday.streaming.incremental import import_by_event_time, import_stream
from matchday.workspace import materialise, new_folder

GAME = ["game_id", "season", "week", "game_type", "home_team", "away_team", "home_score", "away_score"]
LINE = ["recent_team", "season", "week", "season_type", "passing_yards", "carries"]
STAT = ["recent_team", "season", "season_type", "week", "touchdown_points", "passing_yards", "carries"]
ODDS = ["home_moneyline", "away_moneyline", "home_spread_odds", "away_spread_odds", "under_odds", "over_odds"]
STORED = "(season < 2000 OR (season = 2000 AND week <= 10))"


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _path(inputs: Inputs, label: str) -> str:
    return new_folder(inputs.spark, label)


@query("src_feed", table("stg_schedules", GAME, "season IN (1998, 1999, 2000)"))
def src_feed(i: Inputs) -> DataFrame:
    return feeds.frame_feed(i.feed_games)([1998, 1999, 2000]).select(*GAME)


@query("src_incremental", table("stg_weekly_scores", LINE))
def src_incremental(i: Inputs) -> DataFrame:
    """A first import of some periods and a second of the whole feed: the stored table has every period once."""
    name, path = _table_name("weekly"), _path(i, "weekly")
    rows = i.feed_weekly.select(*LINE)
    feeds.import_new(i.spark, feeds.frame_feed(rows.where(STORED)), None, name, path)
    feeds.import_new(i.spark, feeds.frame_feed(rows), None, name, path)
    return i.spark.table(name).select(*LINE)


@query("src_bootstrap", table("stg_schedules", GAME))
def src_bootstrap(i: Inputs) -> DataFrame:
    feed = feeds.frame_feed(i.feed_games.select(*GAME))
    names = _table_name("staging"), _table_name("games")
    return feeds.bootstrap(i.spark, feed, None, *names, (_path(i, "staging"), _path(i, "games"))).select(*GAME)


@query("scan_where", table("int_schedules", GAME, f"season = {CURRENT} AND week <= {CUTOFF}"))
def scan_where(i: Inputs) -> DataFrame:
    view = _table_name("games")
    i.games.createOrReplaceTempView(view)
    return feeds.scan(i.spark, view, f"season = {CURRENT} AND week <= {CUTOFF}").select(*GAME)


SCHEDULE_INPUT = ["game_id", "home_team", "away_team", *GAME_FEATURES]


@query("scan_project", table("int_schedules", SCHEDULE_INPUT, f"season = {CURRENT} AND week = {TARGET}"))
def scan_project(i: Inputs) -> DataFrame:
    view = _table_name("games")
    i.games.createOrReplaceTempView(view)
    return feeds.scan(i.spark, view, f"season = {CURRENT} AND week = {TARGET}", SCHEDULE_INPUT)


@query("src_csv", table("stg_schedules", [*GAME, "spread_line"]))
def src_csv(i: Inputs) -> DataFrame:
    path = _path(i, "csv")
    i.feed_games.select(*GAME, "spread_line").write.option("header", True).csv(path)
    rows = feeds.read_csv(i.spark, path)
    return rows.withColumn("game_id", q("game_id").cast("string"))


_WITH_REJECTS = with_tables(
    f"""SELECT {columns(GAME)}, spread_line, CAST((SELECT count(*) FROM stg_schedules WHERE week % 5 = 0) AS BIGINT) AS rejects
        FROM stg_schedules WHERE week % 5 <> 0""",
    "stg_schedules",
)


@query("src_csv_rejects", _WITH_REJECTS)
def src_csv_rejects(i: Inputs) -> DataFrame:
    """Lines of every fifth week carry a text where a number belongs; they are counted, the others are read by the schema."""
    path = _path(i, "csv")
    rows = i.feed_games.select(*GAME, "spread_line")
    spoilt = F.when(q("week") % 5 == 0, F.lit("n/a")).otherwise(q("spread_line").cast("string"))
    rows.withColumn("spread_line", spoilt).write.option("header", True).csv(path)
    good, bad = feeds.read_csv_strictly(i.spark, path, rows.schema, _path(i, "rejects"))
    return good.join(F.broadcast(bad.agg(F.count(F.lit(1)).alias("rejects"))))


_EVOLVED = with_tables(
    f"""SELECT game_id, CAST(season AS BIGINT) AS season, CAST(week AS DOUBLE) AS week, home_team,
               CASE WHEN season >= {CURRENT} THEN away_team END AS away_team, CASE WHEN season < {CURRENT} THEN home_score END AS home_score
        FROM stg_schedules""",
    "stg_schedules",
)


@query("sink_append_evolving", _EVOLVED)
def sink_append_evolving(i: Inputs) -> DataFrame:
    """Two feeds with different columns, and types that widen, in one table."""
    path = _path(i, "evolving")
    old, new = i.feed_games.where(f"season < {CURRENT}"), i.feed_games.where(f"season >= {CURRENT}")
    sinks.append_evolving(old.select("game_id", "season", "week", "home_team", "home_score"), path)
    sinks.append_evolving(new.select("home_team", "game_id", q("season").cast("long").alias("season"), q("week").cast("double").alias("week"), "away_team"), path)
    return sinks.read_evolving(i.spark, path)


@query("sink_replace", table("int_team_stats", STAT))
def sink_replace(i: Inputs) -> DataFrame:
    name, path = _table_name("team_stats"), _path(i, "replace")
    rows = i.team_stats.select(*STAT)
    sinks.replace_table(rows.where(f"season = {CURRENT}"), name, path)
    sinks.replace_table(rows, name, path)
    return i.spark.table(name)


@query("sink_append", table("stg_schedules", GAME))
def sink_append(i: Inputs) -> DataFrame:
    name, path = _table_name("games"), _path(i, "append")
    rows = i.feed_games.select(*GAME)
    sinks.append_table(rows.where(f"season < {CURRENT}"), name, path)
    sinks.append_table(rows.where(f"season >= {CURRENT}"), name, path)
    return i.spark.table(name)


_CTAS = """
SELECT season, week, count(*) AS games, CAST(sum(outcome) AS BIGINT) AS home_wins, avg(home_score) AS home_points
FROM {games} GROUP BY season, week
"""


@query("sink_ctas", with_tables(_CTAS.format(games="int_schedules"), "int_schedules"))
def sink_ctas(i: Inputs) -> DataFrame:
    name = _table_name("season_weeks")
    return sinks.store_query(i.spark, _CTAS, name, "fail", _path(i, "ctas"), games=i.games)


_INPUT_BODY = f"""
SELECT g.game_id, g.home_team, g.away_team, {columns(GAME_FEATURES, "g")},
       {columns(SIDE_FEATURES, "hs", "_home")}, {columns(SIDE_FEATURES, "aw", "_away")}
FROM int_schedules AS g
LEFT JOIN lag_features AS hs ON hs.recent_team = g.home_team AND hs.season = g.season AND hs.week = g.week
LEFT JOIN lag_features AS aw ON aw.recent_team = g.away_team AND aw.season = g.season AND aw.week = g.week
"""
INPUT_SQL = with_tables(_INPUT_BODY, "int_schedules", "lag_features")


def target_input_sql(week: int) -> str:
    where = f"WHERE g.season = {CURRENT} AND g.week = {week}"
    return with_tables(_INPUT_BODY + where, "int_schedules", "lag_features")


@query("sql_template", target_input_sql(TARGET))
def sql_template(i: Inputs) -> DataFrame:
    return target_week_query(i.spark, i.games, i.team_stats, i.cfg)


def _baseline(i: Inputs) -> DataFrame:
    teams = i.games.select(q("game_id").alias("id"), "home_team", "away_team")
    picks = favourite_baseline(i.games).join(teams, q("game_id") == q("id"))
    return picks.select("game_id", "home_team", "away_team", "predicted_outcome", "season", "week")


PREDICTION = ["game_id", "home_team", "away_team", "predicted_outcome"]
_PICK = "CASE WHEN spread_line > 0 THEN 1 ELSE 0 END AS predicted_outcome"


@query(
    "sink_schema",
    with_tables(f"SELECT game_id, home_team, away_team, {_PICK} FROM int_schedules", "int_schedules"),
)
def sink_schema(i: Inputs) -> DataFrame:
    name, path = _table_name("predictions"), _path(i, "predictions")
    rows = _baseline(i).select(*PREDICTION)
    sinks.append_table(rows, name, path)
    sinks.reset_predictions(i.spark, name, path)
    sinks.append_table(rows, name, path)
    return i.spark.table(name)


@query(
    "sink_upsert_pk",
    with_tables(
        f"""SELECT game_id, home_team, away_team, {_PICK}, week AS prediction_week, true AS stamped, week <= {CUTOFF} AS first_batch
            FROM int_schedules""",
        "int_schedules",
    ),
)
def sink_upsert_pk(i: Inputs) -> DataFrame:
    """All games, in two batches that overlap: what the first stored stays, with its time."""
    name, path = _table_name("predictions"), _path(i, "keyed")
    rows = _baseline(i).withColumnRenamed("week", "prediction_week").select(*PREDICTION, "prediction_week")
    sinks.add_predictions(i.spark, rows.where(q("prediction_week") <= CUTOFF), name, path)
    sinks.add_predictions(i.spark, rows, name, path, on_conflict="skip")
    stored = i.spark.table(name)
    # the time of a batch is one value, so the least of all is found without ordering the rows
    earliest = stored.agg(F.min("created_at").alias("earliest"))
    return stored.join(F.broadcast(earliest)).select(
        *PREDICTION, "prediction_week", q("prediction_timestamp").isNotNull().alias("stamped"), (q("created_at") == q("earliest")).alias("first_batch")
    )


@query("sink_weekly", INPUT_SQL)
def sink_weekly(i: Inputs) -> DataFrame:
    path = _path(i, "weekly")
    rows = lag_feature_rows(i.games, i.team_stats, i.cfg)
    sinks.write_periods(rows, path)
    sinks.write_periods(rows.where(f"season = {CURRENT} AND week = {TARGET}"), path)
    return i.spark.read.parquet(path).select(*INPUT_COLUMNS)


_ANY_ODDS_NULL = " OR ".join(f"{c} IS NULL" for c in ODDS)


@query("sink_debug", table("int_schedules", ["game_id", "season", "week", *ODDS], _ANY_ODDS_NULL))
def sink_debug(i: Inputs) -> DataFrame:
    path = _path(i, "missing")
    rows = i.games.select("game_id", "season", "week", *ODDS)
    found = [r["column_name"] for r in null_counts(rows, ODDS).collect()]
    sinks.write_missing_records(rows, found, path)
    return i.spark.read.schema(rows.schema).parquet(path)


@query("sink_training_snapshot", table("int_schedules", [*GAME_FEATURES, "outcome"]))
def sink_training_snapshot(i: Inputs) -> DataFrame:
    path = _path(i, "training")
    rows = split_features(i.games.select("game_id", "home_team", "away_team", *GAME_FEATURES, "outcome"))
    sinks.write_training_snapshot(rows, path)
    return i.spark.read.schema(rows.schema).parquet(path)


@query("sink_model", with_tables("SELECT game_id, home_team, away_team, true AS is_class, true AS as_before FROM int_schedules", "int_schedules"))
def sink_model(i: Inputs) -> DataFrame:
    """Whether a stored model predicts every game, and as it did before it was stored."""
    path = _path(i, "model")
    model = fit_forest(i.games, list(GAME_FEATURES), ForestSettings(max_depth=4))
    sinks.save_model(model, path)
    before = predict(model, i.games, ["game_id"]).select(q("game_id").alias("id"), q("predicted_outcome").alias("before"))
    found = predict(sinks.load_model(path), i.games).join(before, q("game_id") == q("id"))
    return found.select("game_id", "home_team", "away_team", q("predicted_outcome").isin(0, 1).alias("is_class"), (q("predicted_outcome") == q("before")).alias("as_before"))


@query(
    "preview",
    with_tables(f"SELECT {columns(GAME)} FROM int_schedules ORDER BY season, week, game_id LIMIT 5", "int_schedules"),
)
def preview(i: Inputs) -> DataFrame:
    return feeds.preview(i.games.select(*GAME), ["season", "week", "game_id"])


@query("str_incremental", table("stg_weekly_scores", LINE, f"NOT {STORED}"))
def str_incremental(i: Inputs) -> DataFrame:
    source, target = _path(i, "arriving"), _path(i, "imported")
    rows = i.feed_weekly.select(*LINE)
    rows.write.parquet(source)
    arrived = i.spark.read.parquet(source)
    import_stream(i.spark, source, arrived.schema, arrived.where(STORED), target, _path(i, "progress"))
    return i.spark.read.schema(arrived.schema).parquet(target).select(*LINE)


_SUMS = [f"sum({c}) AS {c}" for c in ("passing_yards", "carries")]
_DELIVERED = f"""
SELECT recent_team, season, season_type, week, CAST(count(*) AS BIGINT) AS lines, {", ".join(_SUMS)},
       CAST((SELECT count(*) FROM int_team_stats WHERE season < {CURRENT}) AS BIGINT) AS late
FROM stg_weekly_scores GROUP BY recent_team, season, season_type, week
"""


@query("str_event_time", with_tables(_DELIVERED, "stg_weekly_scores", "int_team_stats"))
def str_event_time(i: Inputs) -> DataFrame:
    """Team weeks in three deliveries: past seasons; everything again with the rest; past seasons a third time, too late by then."""
    source, target, progress = _path(i, "arriving"), _path(i, "imported"), _path(i, "progress")
    keys = ["recent_team", "season_type"]
    sums = [F.count(F.lit(1)).alias("lines"), F.sum("passing_yards").alias("passing_yards"), F.sum("carries").alias("carries")]
    rows = materialise(i.feed_weekly.groupBy("recent_team", "season", "season_type", "week").agg(*sums), "team-weeks")
    past = rows.where(f"season < {CURRENT}")
    for delivery in (past, rows, past):
        delivery.write.mode("append").parquet(source)
        late = import_by_event_time(i.spark, source, rows.schema, keys, target, progress)
    stored = i.spark.read.schema(rows.schema).parquet(target).select(*rows.columns)
    return stored.withColumn("late", F.lit(late).cast("long"))
