"""Column-level building blocks: predicates, calendar arithmetic, scalars, projections."""
