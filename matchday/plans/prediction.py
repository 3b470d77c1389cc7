"""Prediction with a stored model: the features it expects are stored with it and applied to every batch."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.config import NON_FEATURES, PROFILE_SPEC, SeasonConfig
from matchday.functions import scalars as S
from matchday.functions.predicates import training_rows
from matchday.functions.projections import q, reindex
from matchday.operators.skew import DEFAULT_POLICY, SkewPolicy
from matchday.plans.features import lag_feature_rows, profile_features, target_week_inputs
from matchday.plans.training import ForestSettings, fit_forest, predict, split_features
from matchday.sources.sinks import load_model, save_model

KEYS = ("game_id", "home_team", "away_team")


@dataclass(frozen=True)
class StoredModel:
    """A model and the features its training table had, in order."""

    model: PipelineModel
    features: tuple[str, ...]


def save_with_contract(model: PipelineModel, features: Sequence[str], path: str) -> None:
    """Store the model under ``path`` together with the names of its features.

    The names are written last and into one file, so a folder that has them has the whole model.
    """
    lacking = [c for c in model.stages[0].getInputCols() if c not in features]
    if lacking:
        raise ValueError(f"the model reads columns that are no features: {lacking}")
    spark = SparkSession.active()
    save_model(model, f"{path}/model")
    names = spark.createDataFrame([(json.dumps(list(features)),)], "features string")
    names.coalesce(1).write.mode("overwrite").text(f"{path}/contract")


def load_with_contract(spark: SparkSession, path: str) -> StoredModel:
    """The stored model and its features. A model that reads anything else is refused."""
    features = tuple(json.loads(spark.read.text(f"{path}/contract").first()[0]))
    model = load_model(f"{path}/model")
    lacking = [c for c in model.stages[0].getInputCols() if c not in features]
    if lacking:
        raise ValueError(f"the model reads columns that its contract lacks: {lacking}")
    return StoredModel(model, features)


def apply_contract(rows: DataFrame, features: Sequence[str], keep: Sequence[str] = KEYS) -> DataFrame:
    """``keep`` and exactly ``features``: absent ones are 0, NULLs of present ones stay, the season type is encoded."""
    if "season_type" in features and dict(rows.dtypes).get("season_type") == "string":
        rows = rows.withColumn("season_type", S.season_type_code(q("season_type")))
    return reindex(rows, dict.fromkeys([*keep, *features]))


def predict_with_contract(stored: StoredModel, rows: DataFrame, keep: Sequence[str] = KEYS) -> DataFrame:
    return predict(stored.model, apply_contract(rows, stored.features, keep), keep)


def contract_features(training: DataFrame) -> list[str]:
    """The columns of a training table that are features: all but identifiers and what leaks the result."""
    return [c for c in training.columns if c not in NON_FEATURES]


def fit_with_contract(
    training: DataFrame,
    path: str,
    features: Sequence[str] | None = None,
    settings: ForestSettings = ForestSettings(),
    weight: str | None = None,
) -> StoredModel:
    """Fit a forest on ``training``, store it with its features, and return it as loaded."""
    features = list(features or [c for c in contract_features(training) if c != weight])
    model = fit_forest(split_features(training), features, settings, weight)
    save_with_contract(model, features, path)
    return load_with_contract(training.sparkSession, path)


def profile_inputs(
    schedule: DataFrame,
    history: DataFrame,
    cfg: SeasonConfig,
    features: Sequence[str],
    spec: Mapping[str, str] = PROFILE_SPEC,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The target week's games as the model wants them: results hidden, each side's historical profile, absent features 0."""
    return apply_contract(profile_features(schedule, history, cfg, spec, policy), features)


def predict_from_profiles(
    stored: StoredModel,
    schedule: DataFrame,
    base_model: DataFrame,
    cfg: SeasonConfig,
    spec: Mapping[str, str] = PROFILE_SPEC,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Predict the target week from the profiles of both teams up to the cutoff week."""
    inputs = profile_inputs(schedule, base_model.where(training_rows(cfg)), cfg, stored.features, spec, policy)
    return predict(stored.model, inputs, KEYS)


def predict_week(
    stored: StoredModel, games: DataFrame, team_stats: DataFrame, cfg: SeasonConfig, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Predict the target week from trailing windows; ``week`` says which one it was. No games, no rows."""
    inputs = target_week_inputs(games, team_stats, cfg, policy)
    return predict_with_contract(stored, inputs).withColumn("week", F.lit(cfg.target_week))


def predict_weeks(
    stored: StoredModel,
    games: DataFrame,
    team_stats: DataFrame,
    cfg: SeasonConfig,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Predict every week of the current season by one job; each game has the trailing window before its own week."""
    current = games.where(q("season") == cfg.current_season)
    inputs = lag_feature_rows(current, team_stats, cfg, policy)
    return predict_with_contract(stored, inputs, [*KEYS, "season", "week"])

