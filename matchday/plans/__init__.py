"""Derived tables, feature sets, model training and the walk-forward backtest."""
