"""Feeds, incremental import and table scans.

A feed is any callable ``seasons -> DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchday.operators.joins import distinct_periods, unseen_periods
from matchday.sources.sinks import append_table, replace_table
from matchday.workspace import materialise

PERIOD = ("season", "week")

Feed = Callable[[Sequence[int] | None], DataFrame]


def frame_feed(df: DataFrame) -> Feed:
    """A feed over an existing frame; a season list reaches its scan, None stands for all seasons."""
    return lambda seasons: df if seasons is None else df.where(F.col("season").isin(list(seasons)))


def new_rows(feed: Feed, seasons: Sequence[int] | None, stored: DataFrame | None) -> DataFrame:
    """Feed rows whose (season, week) is not stored yet; everything if nothing is."""
    rows = feed(seasons)
    return rows if stored is None else unseen_periods(rows, stored)


def index_name(table: str) -> str:
    """The table beside ``table`` that lists its periods."""
    return f"{table}_periods"


def in_some_period(periods: DataFrame) -> Column:
    """The seasons and the weeks of some periods, as constants that prune partitions; a calendar is small."""
    found = periods.collect()
    within = [F.col(c).isin(sorted({r[c] for r in found if r[c] is not None})) for c in PERIOD]
    unknown = [F.col(c).isNull() for c in PERIOD if any(r[c] is None for r in found)]
    return reduce(or_, unknown, within[0] & within[1])


@contextmanager
def replaced_partitions(spark: SparkSession) -> Iterator[None]:
    """An overwrite of a partitioned table replaces the partitions that it brings, not the table."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def import_new(
    spark: SparkSession,
    feed: Feed,
    seasons: Sequence[int] | None,
    table: str,
    path: str | None = None,
    calendar: DataFrame | None = None,
) -> None:
    """Append the unseen periods of a feed to ``table``, creating it on the first run.

    What is stored is known from an index of periods beside the table, so the table itself is not read.
    The feed is read once, into a staged copy of its new rows; table and index are written from that.
    The table is partitioned by period and an import replaces the partitions it brings: one
    that stopped before the index was written repeats without doubling a row. ``calendar`` names the periods of a
    feed that is itself partitioned by them, so that Spark prunes those already stored.
    """
    index = index_name(table)
    stored = spark.table(index) if spark.catalog.tableExists(index) else None
    rows = feed(seasons)
    if stored is not None:
        if calendar is not None:
            rows = rows.where(in_some_period(unseen_periods(distinct_periods(calendar), stored)))
        rows = unseen_periods(rows, stored)
    staged = materialise(rows, "import")
    if spark.catalog.tableExists(table):
        by_position = staged.select(*spark.table(table).columns).hint("rebalance", *PERIOD)
        with replaced_partitions(spark):
            by_position.write.mode("overwrite").insertInto(table)
    else:
        writer = staged.hint("rebalance", *PERIOD).write.partitionBy(*PERIOD)
        (writer.option("path", path) if path else writer).saveAsTable(table)
    found = staged.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("rows")).coalesce(1)
    append_table(found, index, f"{path}_periods" if path else None)


def bootstrap(
    spark: SparkSession,
    feed: Feed,
    seasons: Sequence[int] | None,
    staging: str,
    final: str | None = None,
    paths: tuple[str | None, str | None] = (None, None),
) -> DataFrame:
    """The staging table, imported first if it is absent or empty, copied to ``final``."""
    if not spark.catalog.tableExists(staging) or spark.table(staging).isEmpty():
        import_new(spark, feed, seasons, staging, paths[0])
    staged = spark.table(staging)
    if final is None or final == staging:
        return staged
    replace_table(staged, final, paths[1])
    return spark.table(final)


def scan(
    spark: SparkSession, table: str, where: str | None = None, columns: Iterable[str] | None = None
) -> DataFrame:
    """Rows of a table, optionally filtered by a boolean SQL predicate and projected.

    An unknown table, column or non-boolean predicate is an error, not an empty result.
    """
    df = spark.table(table)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without ``schema`` the types are inferred by an extra pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


#: Column of the lines that do not fit the schema.
REJECTED = "rejected_line"


def read_csv_strictly(spark: SparkSession, path: str, schema: StructType | str, rejects: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of CSV with a header, by an explicit schema.

    A line with a value that is not of its column's type, or with too many or too few values, is rejected whole and kept as
    text. Both come from one pass over the files, written first: Spark would otherwise parse only the
    columns a query asks for, and take a line for good whose bad value is in another. ``rejects`` names a folder
    that the rejected lines are also stored in.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    with_line = StructType([*wanted.fields, StructField(REJECTED, StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    parsed = materialise(reader.option("columnNameOfCorruptRecord", REJECTED).schema(with_line).csv(path), "csv")
    good = parsed.where(F.col(REJECTED).isNull()).drop(REJECTED)
    bad = parsed.where(F.col(REJECTED).isNotNull()).select(REJECTED)
    if rejects:
        bad.write.mode("overwrite").parquet(rejects)
    return good, bad


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a given order; Spark keeps only ``rows`` per task."""
    return df.orderBy(*order_by).limit(rows)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
