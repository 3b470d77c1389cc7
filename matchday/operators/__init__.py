"""Relational operators: skew-safe joins, aggregations, trailing windows, exact quantiles."""
