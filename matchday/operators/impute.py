"""Mean imputation as an aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.projections import q


def impute_means(df: DataFrame, fitted_on: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs in ``columns`` by the column means of ``fitted_on``.

    The means are one row, read as a scalar subquery. A column without any value stays NULL.
    """
    means = fitted_on.agg(F.struct(*[F.avg(q(c)).alias(c) for c in columns])).scalar()
    wanted = set(columns)
    filled = [
        F.coalesce(q(c).cast("double"), F.col(f"__means.`{c}`")).alias(c) if c in wanted else q(c)
        for c in df.columns
    ]
    return df.withColumn("__means", means).select(*filled)
