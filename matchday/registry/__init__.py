"""Named queries over the star-schema tables, each with its SQL equivalent where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from matchday.config import PROFILE_SPEC, SeasonConfig, both_sides
from matchday.functions.predicates import cutoff_rows, training_rows
from matchday.operators import aggregate as A
from matchday.plans import tables
from matchday.sources import star_schema
from matchday.workspace import materialise


class Inputs:
    """The two feeds and the derived tables most queries start from; all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.cfg = SeasonConfig()

    @cached_property
    def feed_games(self) -> DataFrame:
        return star_schema.schedules(self.spark, self.folder)

    @cached_property
    def feed_weekly(self) -> DataFrame:
        return star_schema.weekly_scores(self.spark, self.folder)

    @cached_property
    def games(self) -> DataFrame:
        return tables.clean_schedule(self.feed_games)

    @cached_property
    def team_stats(self) -> DataFrame:
        return A.team_week(self.feed_weekly)

    @cached_property
    def schedule(self) -> DataFrame:
        return tables.simple_schedule(self.feed_games, self.cfg)

    @cached_property
    def weekly_scores(self) -> DataFrame:
        return tables.simple_weekly_scores(self.feed_weekly)

    @cached_property
    def base_model(self) -> DataFrame:
        return tables.base_model(self.schedule, self.weekly_scores)

    @cached_property
    def profile_history(self) -> DataFrame:
        """What the side profiles read of the base model, as a written table: they read it twice."""
        rows = self.base_model.where(training_rows(self.cfg) & cutoff_rows(self.cfg.cutoff_week))
        columns = ["season", "week", "home_team", "away_team", *both_sides(PROFILE_SPEC)]
        return materialise(rows.select(*columns), "profile-history")

    @cached_property
    def stored_team_stats(self) -> DataFrame:
        """Team statistics as a written table, for queries that read them several times."""
        return materialise(self.team_stats, "team-stats")

    @cached_property
    def team_results(self) -> DataFrame:
        return tables.team_results(self.team_stats, self.games)

    @cached_property
    def training_data(self) -> DataFrame:
        return tables.training_data(self.games, self.team_stats)


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Inputs], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Inputs` under ``name``."""

    def register(run: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return register


def load() -> dict[str, Query]:
    """All registered queries."""
    from matchday.registry import aggregates, filters, joins, learning, projections, storage, windows  # noqa: F401

    return QUERIES
