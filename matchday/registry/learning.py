"""Splits, imputation, model training, evaluation and the walk-forward backtest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.config import DERIVED_MEASURES, GAME_FEATURES, LAG_AVERAGES, LAG_TOTALS, NON_FEATURES, PROFILE_SPEC, SCHEDULE_COLUMNS, SIDE_FEATURES, TRAINING_FEATURES, WEEKLY_MEASURES, both_sides
from matchday.functions.predicates import target_rows, training_rows
from matchday.functions.projections import q
from matchday.operators import metrics as M
from matchday.operators.impute import impute_means
from matchday.operators.sampling import in_training_part, with_folds
from matchday.plans import prediction as K
from matchday.plans import training as L
from matchday.plans.backtest import backtest_score, favourite_baseline, ledger_predictions, walk_forward_ledger
from matchday.plans.features import target_week_inputs
from matchday.plans.tables import training_data
from matchday.registry import Inputs, query
from matchday.registry.oracle import CURRENT, KICKING_JOIN, SIDE_JOIN, TARGET, TRAINING_ROWS, columns, with_tables
from matchday.registry.joins import profile_sql
from matchday.registry.projections import TRAINING_SQL
from matchday.registry.storage import ODDS
from matchday.workspace import materialise, new_folder, remove

# All trees of the default, of a bounded depth: deeper levels take Spark ML a job each.
FOREST = L.ForestSettings(max_depth=6)


@query("ml_split_xy", TRAINING_SQL.replace("s.home_team, s.away_team, s.outcome,", "s.outcome,", 1))
def ml_split_xy(i: Inputs) -> DataFrame:
    return L.split_features(i.training_data, ["home_team", "away_team"], strict=True)


def _bucket(key: str) -> str:
    return f"CAST(concat('0x', substr(md5(concat({key}, '|42')), 1, 8)) AS BIGINT) % 100 < 70"


_SPLIT = f"SELECT game_id, CASE WHEN {_bucket('game_id')} THEN 'train' ELSE 'test' END AS part FROM int_schedules"


@query("ml_train_test", with_tables(_SPLIT, "int_schedules"))
def ml_train_test(i: Inputs) -> DataFrame:
    part = F.when(in_training_part(q("game_id")), F.lit("train")).otherwise(F.lit("test"))
    return i.games.select("game_id", part.alias("part"))


def _imputed_sql(fit_where: str, apply_where: str) -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in ODDS)
    filled = ", ".join(f"round(coalesce(g.{c}, m.{c}), 6) AS {c}" for c in ODDS)
    return with_tables(
        f"""SELECT g.game_id, {filled} FROM int_schedules AS g
            CROSS JOIN (SELECT {means} FROM int_schedules WHERE {fit_where}) AS m WHERE {apply_where}""",
        "int_schedules",
    )


def _rounded_odds(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ODDS})


@query("ml_impute_mean", _imputed_sql(_bucket("game_id"), "true"))
def ml_impute_mean(i: Inputs) -> DataFrame:
    rows = i.games.select("game_id", *ODDS)
    return _rounded_odds(impute_means(rows, rows.where(in_training_part(q("game_id"))), ODDS))


_BATCH = f"season = {CURRENT} AND week = {TARGET}"


@query("ml_impute_batch", _imputed_sql(_BATCH, _BATCH))
def ml_impute_batch(i: Inputs) -> DataFrame:
    batch = i.games.where(target_rows(i.cfg)).select("game_id", *ODDS)
    return _rounded_odds(impute_means(batch, batch, ODDS))


def _baseline_counts(i: Inputs) -> DataFrame:
    pick = F.when(q("spread_line") > 0, F.lit(1)).otherwise(F.lit(0))
    return M.confusion(i.games.select(q("outcome").alias("label"), pick.alias("prediction")))


_COUNTS = "SELECT outcome AS label, predicted AS prediction, count(*) AS n FROM baseline GROUP BY outcome, predicted"


@query("ml_confusion", with_tables(_COUNTS, "baseline"))
def ml_confusion(i: Inputs) -> DataFrame:
    return _baseline_counts(i)


@query(
    "ml_accuracy",
    with_tables("SELECT count(*) AS n, avg(CASE WHEN outcome = predicted THEN 1 ELSE 0 END) AS accuracy FROM baseline", "baseline"),
)
def ml_accuracy(i: Inputs) -> DataFrame:
    return M.accuracy(_baseline_counts(i))


_AUC = """
SELECT (count(*) FILTER (outcome = 1 AND predicted = 1) / count(*) FILTER (outcome = 1)
        + count(*) FILTER (outcome = 0 AND predicted = 0) / count(*) FILTER (outcome = 0)) / 2 AS roc_auc
FROM baseline
"""


@query("ml_auc_hard", with_tables(_AUC, "baseline"))
def ml_auc_hard(i: Inputs) -> DataFrame:
    return M.auc_of_hard_labels(_baseline_counts(i))


def _report_sql(source: str) -> str:
    per_class = f"""
    SELECT c.class, coalesce(hits / nullif(predicted, 0), 0) AS "precision", coalesce(hits / nullif(support, 0), 0) AS recall,
           coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1, support
    FROM (SELECT CAST(class AS VARCHAR) AS class,
                 (SELECT count(*) FROM {source} WHERE label = class AND prediction = class) AS hits,
                 (SELECT count(*) FROM {source} WHERE prediction = class) AS predicted,
                 (SELECT count(*) FROM {source} WHERE label = class) AS support
          FROM (VALUES (0), (1)) AS v(class)) AS c"""
    return f"""
    SELECT class, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1,
           CAST(support AS BIGINT) AS support
    FROM (
      {per_class}
      UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) FROM ({per_class}) AS m
      UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM ({per_class}) AS w
    ) AS report"""


def _report(counts: DataFrame) -> DataFrame:
    return M.class_report(counts).withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("ml_class_report", with_tables(_report_sql("(SELECT outcome AS label, predicted AS prediction FROM baseline)"), "baseline"))
def ml_class_report(i: Inputs) -> DataFrame:
    return _report(_baseline_counts(i))


@query("ml_class_report_labels", _report_sql("(SELECT quality AS label, 1 - toxic AS prediction FROM labels)"))
def ml_class_report_labels(i: Inputs) -> DataFrame:
    labels = i.spark.read.parquet(f"{i.folder}/labels.parquet")
    return _report(M.confusion(labels.select(q("quality").alias("label"), (1 - q("toxic")).alias("prediction"))))


_FOLDS = """
SELECT game_id, outcome, CAST((row_number() OVER (PARTITION BY outcome ORDER BY md5(concat(game_id, '|42')), game_id) - 1) % 5 AS INTEGER) AS fold
FROM int_schedules
"""


@query("ml_cv_folds", with_tables(_FOLDS, "int_schedules"))
def ml_cv_folds(i: Inputs) -> DataFrame:
    return with_folds(i.games.select("game_id", "outcome"), "game_id", "outcome")


def _weighted_training(i: Inputs) -> DataFrame:
    """Statistics are stored first, so that what was shuffled for them is gone when the games are joined."""
    scratch = new_folder(i.spark, "statistics")
    try:
        stats = materialise(i.team_stats.select("recent_team", "season", "week", *SIDE_FEATURES), "team-stats", at=scratch)
        rows = training_data(i.games, stats, weight="weight", keep=["game_id"])
        return materialise(rows.where(training_rows(i.cfg)).drop("home_team", "away_team"), "training")
    finally:
        remove(i.spark, scratch)


_TRAINING = f"""(
    SELECT s.game_id, s.outcome, {columns(GAME_FEATURES, "s")}, {columns(SIDE_FEATURES, "hs", "_home")}, {columns(SIDE_FEATURES, "aw", "_away")}
    FROM int_schedules AS s {SIDE_JOIN} {KICKING_JOIN})"""


def _training_sql(body: str, where: str = TRAINING_ROWS) -> str:
    """``body`` over ``training``, the repeated training rows, and ``games_trained``, each of them once."""
    both = f"training AS (SELECT * FROM {_TRAINING} AS whole WHERE {where}), games_trained AS (SELECT DISTINCT * FROM training)"
    return with_tables("", "int_schedules", "int_team_stats", "kicking_stats").rstrip() + f",\n{both}\n{body}"


def _is_share(column: str) -> Column:
    return q(column).between(0.0, 1.0)


def _is_class(column: str = "predicted_outcome") -> Column:
    return q(column).isin(0, 1)


@query("ml_cv", _training_sql("SELECT CAST(5 AS INTEGER) AS folds, count(*) AS rows, true AS is_share FROM training"))
def ml_cv(i: Inputs) -> DataFrame:
    rows = _weighted_training(i)
    accuracy = L.cross_validated_accuracy(rows, TRAINING_FEATURES, "game_id", FOREST, weight="weight")
    found = rows.agg(F.lit(5).alias("folds"), F.sum("weight").alias("rows"), F.lit(float(accuracy)).alias("accuracy"))
    return found.select("folds", "rows", _is_share("accuracy").alias("is_share"))


def _model(i: Inputs):
    rows = _weighted_training(i)
    return L.fit_forest(rows, TRAINING_FEATURES, FOREST, "weight"), rows


@query("ml_rf", _training_sql("SELECT outcome AS label, count(*) AS support, true AS is_class FROM training GROUP BY outcome"))
def ml_rf(i: Inputs) -> DataFrame:
    """Of the confusion counts of a forest, what does not depend on its draws: the support of every label."""
    model, rows = _model(i)
    counts = L.score_counts(model, rows, "weight")
    return counts.groupBy("label").agg(F.sum("n").alias("support"), F.every(_is_class("prediction")).alias("is_class"))


_THIS_WEEK = f"SELECT game_id, home_team, away_team, week, true AS is_class FROM int_schedules WHERE season = {CURRENT} AND week = {TARGET}"


@query("ml_predict", with_tables(_THIS_WEEK, "int_schedules"))
def ml_predict(i: Inputs) -> DataFrame:
    model, _ = _model(i)
    inputs = target_week_inputs(i.games, i.team_stats, i.cfg)
    found = L.predict(model, inputs, ["game_id", "home_team", "away_team", "week"])
    return found.select("game_id", "home_team", "away_team", "week", _is_class().alias("is_class"))


_FEATURE_NAMES = ", ".join(f"('{c}')" for c in TRAINING_FEATURES)


@query("ml_importance", f"SELECT feature, true AS is_share, true AS adds_up FROM (VALUES {_FEATURE_NAMES}) AS names(feature)")
def ml_importance(i: Inputs) -> DataFrame:
    model, rows = _model(i)
    found = L.importances(model, rows)
    total = found.agg(F.round(F.sum("importance"), 9).alias("total"))
    return found.join(F.broadcast(total)).select("feature", _is_share("importance").alias("is_share"), (q("total") == 1).alias("adds_up"))


_PIPELINE = (
    " UNION ALL ".join(
        f"SELECT 'null_count' AS section, '{c}' AS name, CAST(count(*) FILTER (\"{c}\" IS NULL) AS DOUBLE) AS value FROM games_trained HAVING value > 0"
        for c in TRAINING_FEATURES
    )
    + " UNION ALL SELECT 'score', unnest(['accuracy', 'roc_auc', 'cv_accuracy']), 1.0"
    + f" UNION ALL SELECT 'support', CAST(outcome AS VARCHAR), CAST(count(*) AS DOUBLE) FROM training WHERE NOT ({_bucket('game_id')}) GROUP BY outcome"
    + f" UNION ALL SELECT 'importance', 'features', CAST({len(TRAINING_FEATURES)} AS DOUBLE)"
)


@query("ml_pipeline", _training_sql(_PIPELINE))
def ml_pipeline(i: Inputs) -> DataFrame:
    """Nulls and supports as they are; a score or an importance shows as 1 where it is a share."""
    run = L.train_and_report(_weighted_training(i), TRAINING_FEATURES, settings=FOREST, weight="weight")
    classes = run.report.where(q("class").isin("0", "1") & (q("support") > 0))
    ranked = run.importances.where(_is_share("importance")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    parts = [
        run.nulls.select(F.lit("null_count").alias("section"), q("column_name").alias("name"), q("null_count").cast("double").alias("value")),
        run.scores.select(F.lit("score").alias("section"), q("metric").alias("name"), _is_share("value").cast("double").alias("value")),
        classes.select(F.lit("support").alias("section"), q("class").alias("name"), q("support").cast("double").alias("value")),
        ranked.select(F.lit("importance").alias("section"), F.lit("features").alias("name"), "value"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_WALKED = f"""
SELECT g.game_id, g.home_team, g.away_team, g.season, g.week, true AS is_class, true AS is_scored,
       count(*) OVER (PARTITION BY g.week) AS games, CAST(train_rows AS BIGINT) AS train_rows
FROM int_schedules AS g JOIN (
    SELECT CAST(w AS INTEGER) AS week, count(*) AS train_rows
    FROM training, (SELECT unnest(range(1, 23)) AS w) AS weeks
    WHERE CASE WHEN w = 1 THEN season = {CURRENT} - 1 ELSE season < {CURRENT} OR (season = {CURRENT} AND week < w) END
    GROUP BY w
) AS before ON before.week = g.week
WHERE g.season = {CURRENT}
"""


#: What training rows and inputs take from games and from statistics.
_GAMES_READ = ["game_id", "home_team", "away_team", "outcome", *GAME_FEATURES]
_STATISTICS_READ = list(dict.fromkeys(["recent_team", "season", "week", *SIDE_FEATURES, *LAG_AVERAGES.values(), *LAG_TOTALS]))


@query("ml_backtest", _training_sql(_WALKED, "true"))
def ml_backtest(i: Inputs) -> DataFrame:
    """Every week of the season, each predicted once: a run over its first weeks, and one that goes on."""
    folder, scratch = new_folder(i.spark, "ledger"), new_folder(i.spark, "backtest")
    small = L.ForestSettings(trees=20, max_depth=4)
    try:
        # each run reads them for training rows and inputs
        games = materialise(i.games.select(*_GAMES_READ), "games", at=scratch)
        stats = materialise(i.team_stats.select(*_STATISTICS_READ), "team-stats", at=scratch)
        walk_forward_ledger(games, stats, i.cfg, folder, range(1, i.cfg.cutoff_week), small)
        periods = walk_forward_ledger(games, stats, i.cfg, folder, None, small)
    finally:
        remove(i.spark, scratch)
    scored = periods.select("season", "week", "games", "train_rows", _is_share("hold_out_accuracy").alias("is_scored"))
    found = ledger_predictions(i.spark, folder).join(scored, ["season", "week"])
    return found.select("game_id", "home_team", "away_team", "season", "week", _is_class().alias("is_class"), "is_scored", "games", "train_rows")


_RANK_AUC = """
SELECT round((sum(place) FILTER (outcome = 1) - n_up * (n_up + 1) / 2) / (n_up * n_down), 9) AS roc_auc
FROM (SELECT outcome, rank() OVER (ORDER BY spread_line) + (count(*) OVER (PARTITION BY spread_line) - 1) / 2 AS place
      FROM int_schedules WHERE spread_line IS NOT NULL) AS placed,
     (SELECT count(*) FILTER (outcome = 1) AS n_up, count(*) FILTER (outcome = 0) AS n_down FROM int_schedules WHERE spread_line IS NOT NULL) AS sizes
GROUP BY n_up, n_down
"""


@query("ml_auc_scores", with_tables(_RANK_AUC, "int_schedules"))
def ml_auc_scores(i: Inputs) -> DataFrame:
    """The area under the ROC curve of a score with ties, the spread."""
    return M.auc_of_scores(i.games, "outcome", "spread_line").select(F.round("roc_auc", 9).alias("roc_auc"))


_SCORED = """
SELECT season, week, count(*) AS games, CAST(sum(CASE WHEN predicted = outcome THEN 1 ELSE 0 END) AS BIGINT) AS hits,
       avg(CASE WHEN predicted = outcome THEN 1 ELSE 0 END) AS accuracy
FROM baseline GROUP BY season, week
"""


@query("ml_backtest_score", with_tables(_SCORED, "baseline"))
def ml_backtest_score(i: Inputs) -> DataFrame:
    return backtest_score(favourite_baseline(i.games), i.games)


BASE_FEATURES = [c for c in SCHEDULE_COLUMNS if c not in NON_FEATURES] + both_sides([*WEEKLY_MEASURES, *DERIVED_MEASURES])


def _profile_column(name: str) -> str:
    """A feature of the base model, as the inputs of a prediction have it."""
    if name in ("home_score", "away_score"):
        return f"CAST(0 AS DOUBLE) AS {name}"
    if name == "season_type":
        return "CASE s.season_type WHEN 'REG' THEN 0 WHEN 'POST' THEN 1 END AS season_type"
    if name in SCHEDULE_COLUMNS:
        return columns([name], "s")
    measure, alias = (name[: -len("_home")], "hp") if name.endswith("_home") else (name[: -len("_away")], "ap")
    return f'{alias}."{measure}" AS "{name}"' if measure in PROFILE_SPEC else f'0 AS "{name}"'


_PROFILE_INPUTS = f"""
SELECT s.game_id, s.home_team, s.away_team, {", ".join(map(_profile_column, BASE_FEATURES))}, true AS is_class
FROM schedules AS s
LEFT JOIN ({profile_sql("home")}) AS hp ON hp.team = s.home_team
LEFT JOIN ({profile_sql("away")}) AS ap ON ap.team = s.away_team
WHERE s.season = {CURRENT} AND s.week = {TARGET}
"""


@query("predict_profiles", with_tables(_PROFILE_INPUTS, "schedules", "history"))
def predict_profiles(i: Inputs) -> DataFrame:
    """The target week by a stored model of the base table: its features by the stored contract, and whether each game got a class."""
    history = materialise(i.base_model.where(training_rows(i.cfg)), "base-history")
    stored = K.fit_with_contract(history, new_folder(i.spark, "base-forest"), settings=L.ForestSettings(max_depth=4))
    inputs = materialise(K.profile_inputs(i.schedule, history, i.cfg, stored.features), "profile-inputs")
    found = L.predict(stored.model, inputs, ["game_id"]).select(q("game_id").alias("id"), _is_class().alias("is_class"))
    return inputs.join(found, q("game_id") == q("id")).drop("id")


@query("predict_stored", with_tables(f"SELECT game_id, home_team, away_team, season, week, true AS is_class FROM int_schedules WHERE season = {CURRENT}", "int_schedules"))
def predict_stored(i: Inputs) -> DataFrame:
    """Every week of the season from trailing windows, by a model that is loaded with its contract."""
    rows = _weighted_training(i)
    stored = K.fit_with_contract(rows, new_folder(i.spark, "forest"), TRAINING_FEATURES, L.ForestSettings(max_depth=4), "weight")
    found = K.predict_weeks(stored, i.games, i.team_stats, i.cfg)
    return found.select("game_id", "home_team", "away_team", "season", "week", _is_class().alias("is_class"))
