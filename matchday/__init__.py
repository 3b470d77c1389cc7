"""Matchup analytics as Spark DataFrame operators.

Entities (teams) produce statistics per period and meet in scheduled games. The package turns the
two raw feeds into team-period facts, two-sided game features, trailing-window profiles, training
sets, fitted models and walk-forward predictions. Every function takes and returns a lazy
``DataFrame`` unless its name says that it writes or fits.
"""

from matchday.config import SeasonConfig

__all__ = ["SeasonConfig"]
